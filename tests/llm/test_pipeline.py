"""The corpus pipeline on a small corpus: every stage against a brute-force version on its own input."""

from __future__ import annotations

import random

import corpus_pipeline
from gradeline.llm import quality
from gradeline.sources.stage import stage
from tests.llm.test_near_blocks import brute

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def prose(rng, n):
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randrange(2, 9))) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def corpus(rng):
    texts = [prose(rng, 150 if i in (11, 13, 14) else rng.randrange(40, 120)) for i in range(60)]
    bad = ["|".join(f"#{rng.randrange(10**6)}$%" for _ in range(60)) for _ in range(25)]
    item = prose(rng, 30)
    leaks = [prose(rng, 40) + " " + item + " " + prose(rng, 20) for _ in range(3)]
    copies = [texts[3], texts[3].upper(), texts[4], texts[4]]
    near = []
    for share in (1, 3, 4):  # of 146 shingles a changed word takes five: similarities of 0.93, 0.81 and 0.76
        words = texts[10 + share].split()
        for k in range(share):
            words[7 + 9 * k] = f"changed{k}"
        near.append(" ".join(words))
    everything = texts + bad + leaks + copies + near + ["", None, "one", "two words"]
    rows = [(i, t, rng.choice(["en", "de"]), rng.choice(["a", "a", "b", None]), len(t or "")) for i, t in enumerate(everything)]
    labels = [(i, 1, 0) for i in range(60)] + [(i, 0, 0) for i in range(60, 85)] + [(86, None, 0), (None, 1, 0)]
    return rows, labels, item


def write(spark, folder, rows, labels, item):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_every_stage_and_the_whole(spark, tmp_path):
    rows, labels, item = corpus(random.Random(6))
    sf_dir = str(tmp_path)
    write(spark, sf_dir, rows, labels, item)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, after = docs.columns, {}
    for name, function in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        result = stage(function(spark, docs, sf_dir), name)
        got = ids(result)
        if name == "quality":
            scores = quality.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            assert got == ids(scores.filter("predicted = 1"))
            assert set(range(60)) <= set(got) and not set(range(60, 85)) & set(got)
        elif name == "exact_dedup":
            last = {}
            for i, t in sorted(before.items()):
                last["".join(c.lower() if c.isascii() else c for c in t or "")] = i
            assert got == sorted(last.values()) and len(got) < len(before)
        elif name == "near_dedup":
            groups = brute([(i, t or "") for i, t in before.items()], 80)
            assert got == sorted(set(groups.values())) and len(got) < len(before)
        elif name == "decontamination":
            assert got == sorted(i for i, t in before.items() if item not in (t or "")) and len(got) < len(before)
        else:
            assert set(got) <= set(before) and len(got) > 0 and all(r.taken > 0 for r in result.collect())
        if name != "mixing":
            assert result.columns == columns
        docs, after[name] = result, got
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_a_pipeline_without_documents(spark, tmp_path):
    rows, labels, item = corpus(random.Random(6))
    write(spark, str(tmp_path), [], labels, item)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
