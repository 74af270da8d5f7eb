"""Edge cases and brute-force versions of the training-data operators."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeline.llm import (
    chunk_dedup, components, decontaminate, mixing, near_dedup, quality, suffix_dedup, token_scan, toxicity, url_filter, warc, words,
)

DOCS = "doc_id long, text string, source string, kept string, size string, host string, best string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """Documents with extra columns whose names clash with columns of the operators."""
    return spark.createDataFrame([(i, t, s, "x", "x", "x", "x") for i, t, s in rows], DOCS)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_documents(rng):
    long = prose(rng, 30_000, 5000)
    return [(1, None, "a"), (2, "", None), (3, " \t\n", "a"), (4, "One Two", "a"), (5, "one two", "b"), (None, "one two", "b"),
            (6, long, "a"), (7, long.upper(), "b"), (8, long, "a"), (8, long, "a"), (9, "É é", None), (10, "é é", "a"), (None, None, None)]


# --- words -----------------------------------------------------------------------------------------


def test_word_hashes_do_not_depend_on_slabs():
    rng = random.Random(1)
    texts = [b"", b" a  b\x0bc ", prose(rng, 50).encode(), prose(rng, 120_000).encode(), b"a b", "ä ö".encode()]
    own = {t: h for t in texts for _, h, _ in words.word_hashes([t])}
    found = [h[o[i]:o[i + 1]] for n, h, o in words.word_hashes(texts) for i in range(n)]
    for text, hashes in zip(texts, found):
        assert len(hashes) == len(text.split()) and (hashes == own[text]).all()
    tokens, flat = [w for t in texts for w in t.split()], np.concatenate(found)
    assert len(set(zip(tokens, flat.tolist()))) == len(set(tokens)) == len(set(flat.tolist()))


def test_shingles_of_short_texts():
    (n, h, o), = words.word_hashes([b"a b", b"", b"a b c d e f", b"a b"])
    shingles, at = words.shingle_hashes(h, o, 5)
    assert np.diff(at).tolist() == [1, 0, 2, 1] and shingles[0] == shingles[-1]


# --- archives --------------------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    big, trap = "x" * 1500, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40
    rows = [(1, "http://a/\r\nX: y", big), (2, None, big), (3, "u", None), (4, "u", "é" * 600), (4, "u", "é" * 600), (None, "u", big), (5, "u", trap), (6, "v", "s"), (7, "v", "s")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    for compression in ("none", "gzip"):
        path = f"file://{tmp_path}/{compression}"
        warc.write_warc(pages, path, compression=compression)
        got = warc.read_warc(spark, path).collect()
        kinds = sorted((r.record_id, r.record_type, r.refers_to) for r in got)
        assert len(got) == len(rows)
        assert [k[1] for k in kinds].count("revisit") == 2 and ("<urn:page:1>", "revisit", "<urn:page:2>") in kinds
        assert sorted(bytes(r.payload).decode() for r in got if r.record_type == "response") == sorted([big, "", "é" * 600, "é" * 600, trap, "s", "s"])
        for r in got:
            if r.payload is not None:
                assert r.payload_digest == hashlib.sha1(r.payload).hexdigest() and r.payload_bytes == len(r.payload)
        only = warc.read_warc(spark, path, "none").filter((F.col("record_type") == "response") & F.col("target_uri").startswith("v"))
        assert only.count() == 2 and only.filter("payload is not null").count() == 0
        assert "X: y" not in {h for r in got for h in (r.record_id, r.content_type)}


def test_warc_of_no_pages(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/e")
    assert warc.read_warc(spark, f"file://{tmp_path}/e").count() == 0


def test_cut_archive_raises(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 10\r\n\r\nabc")
    with pytest.raises(Exception, match="ends early"):
        warc.read_warc(spark, f"file://{tmp_path}").collect()


# --- mixing ----------------------------------------------------------------------------------------


def test_mix_meets_targets_and_quotas(spark):
    rng = random.Random(2)
    docs = frame(spark, [(i, prose(rng, rng.randrange(200)), rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(600)])
    sized, draws = mixing.mix(docs)
    target = {r.source: r.target for r in sized.select("source", "target").distinct().collect()}
    size = {r.source: r.source_size for r in sized.select("source", "source_size").distinct().collect()}
    got = {r.source: r.w for r in draws.groupBy("source").agg(F.sum("words").alias("w")).collect()}
    assert all(abs(got[s] - target[s]) <= 1 and target[s] <= 2 * size[s] + 1e-6 for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-3
    per = draws.groupBy("doc_id").agg(F.sum("words").alias("w"), F.first("size").alias("s")).collect()
    assert all(r.w <= 2 * r.s for r in per)
    shards = {r.shard for r in draws.select("shard").distinct().collect()}
    assert shards == set(range(2**mixing.LEVELS))
    assert sorted(map(tuple, draws.collect())) == sorted(map(tuple, mixing.mix(docs)[1].collect()))


def test_split_quotas_are_exact(spark):
    quotas = spark.createDataFrame([("a", 37), ("b", 1), ("c", 200), ("d", 0)], "source_key string, quota long")
    rows = mixing.split_quotas(quotas, 3).collect()
    for source, quota in (("a", 37), ("b", 1), ("c", 200)):
        assert sum(r.quota for r in rows if r.source_key == source) == quota
    per = [sum(r.quota for r in rows if r.shard == s) for s in range(8)]
    assert sum(per) == 238 and max(per) - min(per) <= 1


def test_mix_of_odd_documents(spark):
    rows = mixing.taken_words(frame(spark, odd_documents(random.Random(3)))).collect()
    assert len(rows) == 13 and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.taken_words(frame(spark, [])).count() == 0


# --- near duplicates -------------------------------------------------------------------------------


def brute_components(rows):
    def shingles(text):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for i, x in sets:
            for j, y in sets:
                if x and i < j and 100 * len(x & y) >= 85 * len(x | y) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return {i: (len(x), label[i]) for i, x in sets}


def test_near_groups_equal_brute_force(spark):
    rng = random.Random(4)
    rows, base = [], [prose(rng, 120).split() for _ in range(12)]
    for i in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(w)))
    rows += [(5000, None), (5001, ""), (5002, "a B"), (5003, "A b"), (5004, "a b c d"), (5005, rows[0][1].upper())]
    got = near_dedup.near_groups(frame(spark, [(*r, "s") for r in rows])).collect()
    want = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_groups_of_odd_documents(spark):
    docs = frame(spark, odd_documents(random.Random(5)))
    got = near_dedup.near_groups(docs).collect()
    assert len(got) == 13 and {r.component_id for r in got if r.doc_id in (6, 7, 8)} == {6}
    assert {r.doc_id for r in got if not r.kept} == {5, 7, 8}  # 9 and 10 differ, as only A-Z are lower-cased
    assert near_dedup.drop_near_copies(docs).columns == docs.columns
    assert near_dedup.near_groups(frame(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (300, 200), (7, 7)]
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 200: 100, 300: 100}


# --- classifiers -----------------------------------------------------------------------------------


def labelled(spark, rng, column):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = prose(rng, 60)
        if bad:
            text = text.upper().replace(" ", "!! ") if column == "quality" else text.replace("w1", "nasty1", 2)
        rows.append((i, text, "s"))
        labels.append((i, int(bad != (column == "quality"))))
    rows += [(1000, None, None), (1001, "", "s"), (None, "a b", "s"), (3, rows[3][1], "s")]
    return frame(spark, rows), spark.createDataFrame([*labels, (None, 1), (5, None), (5, labels[5][1])], f"doc_id long, {column} int")


@pytest.mark.parametrize(("operator", "column"), [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_on_held_out_rows(spark, operator, column):
    docs, labels = labelled(spark, random.Random(6), column)
    got = operator.score(docs, labels)
    assert got.count() == 404 and got.filter("score is null or score < 0 or score > 1").count() == 0
    held = got.filter("held_out").join(labels.filter(f"{column} is not null").distinct(), "doc_id").collect()
    assert len(held) > 50 and np.mean([r.predicted == r[column] for r in held]) > 0.9
    none = operator.score(docs, labels.filter(f"{column} = 2"))
    assert {r.score for r in none.collect()} == {0.5}
    assert {r.score for r in operator.score(docs, labels.filter(f"{column} = 1")).collect()} == {1.0}
    assert operator.score(docs.limit(0), labels).count() == 0


def test_quality_filter_keeps_columns(spark):
    docs, labels = labelled(spark, random.Random(7), "quality")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 250 < kept.filter("doc_id < 400").count() < 350


def test_languages():
    (n, h, o), = words.word_hashes([b"the cat and of", b"der hund und nicht", b"", b"el y los", b"le et les"], toxicity.PREFIXES)
    assert [toxicity.LANGUAGES[i] for i in toxicity.languages(h[:, 0], o)] == ["en", "de", "other", "es", "fr"]


# --- substrings ------------------------------------------------------------------------------------


def brute_removed(rows, window=20):
    seen, out = {}, {}
    for i, text in sorted(rows):
        w = WORD.findall(text or "")
        gone = set()
        for s in range(len(w) - window + 1):
            if seen.setdefault(tuple(w[s:s + window]), (i, s)) != (i, s):
                gone.update(range(s, s + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("group_rows", [100_000, 3])
def test_removed_words_equal_brute_force(spark, group_rows):
    rng = random.Random(8)
    shared = [prose(rng, n) for n in (20, 25, 60, 19)]
    rows = [(i, " ".join(rng.choice([prose(rng, rng.randrange(30)), rng.choice(shared)]) for _ in range(6))) for i in range(80)]
    rows += [(200, "a b " * 40), (201, "z " * 33), (202, None), (203, ""), (204, rows[3][1]), (205, "q\x0b" + shared[2] + "\x85 r")]
    rng.shuffle(rows)
    got = suffix_dedup.remove_repeats(frame(spark, [(*r, "s") for r in rows]), group_rows=group_rows).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in got} == brute_removed(rows)


def test_removal_from_odd_documents(spark):
    got = suffix_dedup.remove_repeats(frame(spark, odd_documents(random.Random(9)))).collect()
    assert len(got) == 13
    assert sorted(r.n_removed for r in got if r.doc_id in (6, 7, 8)) == [0, 0, 30_000, 30_000]  # upper case differs
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


# --- benchmark -------------------------------------------------------------------------------------


def brute_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def test_myers_equals_dynamic_programming():
    rng = random.Random(10)
    for _ in range(300):
        item = np.array([rng.randrange(5) for _ in range(rng.randrange(1, 90))])
        text = np.array([rng.randrange(5) for _ in range(rng.randrange(0, 120))])
        assert decontaminate.distance(item, text) == brute_distance(item.tolist(), text.tolist())


def test_leaks_equal_brute_force(spark):
    rng = random.Random(11)
    items = [(i, prose(rng, n, 90)) for i, n in enumerate((1, 5, 7, 13, 30, 45, 80))] + [(9, None), (10, "..."), (11, "")]
    rows = []
    for d in range(120):
        w = prose(rng, rng.randrange(60), 90).split()
        if d % 2:
            leak = rng.choice(items[1:7])[1].split()
            for _ in range(rng.randrange(10)):
                k = rng.randrange(len(leak))
                leak[k:k + 1] = rng.choice([[], ["new"], [leak[k].upper() + ","], [leak[k], "put"]])
                leak = leak or ["x"]
            w[3:3] = leak
        rows.append((d, " ".join(w)))
    rows += [(500, None), (501, ""), (502, "Ä" + items[3][1])]
    docs, bench = frame(spark, [(*r, "s") for r in rows]), spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, text in rows:
        for i, item in items:
            a, b = (decontaminate.plain(t).split() for t in (item, text))
            if a and (found := brute_distance(a, b)) <= decontaminate.budget_of(len(a)):
                want.add((d, i, found))
    for chars in (4_000_000, 300):
        got = decontaminate.find_leaks(docs, bench, block_chars=chars).collect()
        assert {(r.doc_id, r.item_id, r.distance) for r in got} == want and len(got) == len(want)
        clean = decontaminate.drop_leaks(docs, bench, block_chars=chars)
        assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _, _ in want}
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0 and decontaminate.find_leaks(docs.limit(0), bench).count() == 0


# --- exact copies ----------------------------------------------------------------------------------


def test_exact_groups_of_odd_documents(spark):
    docs = frame(spark, odd_documents(random.Random(12)))
    got = sorted(((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in chunk_dedup.exact_groups(docs).collect()), key=str)
    assert (4, 5, 3, False) in got and (5, 5, 3, True) in got and (0, 5, 3, False) in got
    assert (1, 2, 3, False) in got and (3, 3, 1, True) in got and got.count((8, 8, 4, True)) == 2 and (6, 8, 4, False) in got
    kept = chunk_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 8, 8, 9, 10]
    assert chunk_dedup.exact_groups(frame(spark, [])).count() == 0


def test_chunks_lose_nothing(spark):
    rng = random.Random(13)
    texts = ["", "a", "é𝒳\n" * 9000, prose(rng, 5000), "x" * 30_000, prose(rng, 100) + "\n\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", chunk_dedup.chunks(F.col("text")).alias("c")).collect()
    assert all("".join(r.c) == r.text and max(map(len, r.c), default=0) <= chunk_dedup.MAX_CHUNK for r in rows)


def test_colliding_fingerprints_are_found(spark):
    docs = frame(spark, [(1, "aa", "s"), (2, "bb", "s"), (3, "aa", "s")])
    weak = lambda c: F.length(c)
    strong = lambda c: F.sha2(c, 256)
    assert sorted((r.doc_id, r.keep_id) for r in chunk_dedup.exact_groups(docs, (weak, strong)).collect()) == [(1, 3), (2, 2), (3, 3)]
    with pytest.raises(ValueError, match="identifier"):
        chunk_dedup.exact_groups(docs, (weak,))


# --- tokens ----------------------------------------------------------------------------------------


def test_scan_of_flat_files(spark, tmp_path):
    rng, want, files = random.Random(14), {}, []
    for f in range(3):
        lengths = [rng.choice([0, 0, 1, 5, 40]) for _ in range(50)]
        ids = [x for n in lengths for x in [*rng.choices(range(1000), k=n), token_scan.END]] + [7] * (f == 1)
        path = tmp_path / f"{f}.bin"
        path.write_bytes(np.array(ids, "<u2").tobytes())
        files.append((str(path),))
        want |= {(str(path), i): n for i, n in enumerate(lengths + [1] * (f == 1))}
    (tmp_path / "none.bin").write_bytes(b"")
    files.append((str(tmp_path / "none.bin"),))
    for block in (2, 6, 64, 1 << 20):
        got = token_scan.scan(spark.createDataFrame(files, "file string"), f"file://{tmp_path}", block_bytes=block).collect()
        assert {(r.file, r.ordinal): r.n_tokens for r in got} == want and len(got) == len(want)


def test_token_counts(spark):
    rng = random.Random(15)
    rows = odd_documents(rng) + [(20, "<|endoftext|> x", "s")]
    got = token_scan.token_counts(frame(spark, rows)).collect()
    count = lambda t: len(token_scan.encoder(token_scan.VOCABULARY).encode_ordinary(t or ""))
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted((i or 0, count(t)) for i, t, _ in rows)
    assert token_scan.token_counts(frame(spark, [])).count() == 0


# --- URLs ------------------------------------------------------------------------------------------


def test_url_rules(spark):
    rules = [("org", "/", "allow"), ("a.org", "/x", "block"), ("a.org", "/x", "allow"), ("net", "", "block"), (None, "/", "block")]
    urls = ["http://A.org/xy?q", "http://b.a.org/y#x", "http://ba.org", "//org/", None, "", "http://net", "x://z.net?/", "http://a.com/", "a://b://org/", "http://org/"]
    want = [("a.org", "/xy", "a.org/x", "block"), ("b.a.org", "/y", "org/", "allow"), ("ba.org", "", None, "allow"), ("", "", None, "allow"),
            ("", "", None, "allow"), ("", "", None, "allow"), ("net", "", "net", "block"), ("z.net", "", "net", "block"), ("a.com", "/", None, "allow"),
            ("b:", "//org/", None, "allow"), ("org", "/", "org/", "allow")]
    pages = spark.createDataFrame([(i, u, "x", "x", "x", "x") for i, u in enumerate(urls)], "page_id long, url string, host string, h string, best string, key string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = url_filter.apply_rules(pages, table)
    assert [(r.host, r.path, r.rule, r.verdict) for r in got.orderBy("page_id").collect()] == want
    assert {r.verdict for r in url_filter.apply_rules(pages, table.limit(0)).collect()} == {"allow"}
    assert url_filter.apply_rules(pages.limit(0), table).count() == 0


def test_small_filter_only_gives_false_hits(spark):
    listed = spark.createDataFrame([(f"h{i}.com/", "h") for i in range(500)], "key string, x string")
    blocks, n = url_filter.bloom_filter(listed, max_blocks=4)
    assert n == 4 and blocks.count() <= 4
