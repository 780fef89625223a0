import math
import os
import re
from collections import Counter

import pytest
from cases import edge_docs, edge_rows

from lapwise.llm import importance


def tokens(text):
    data = (text or "").encode().lower()
    return re.findall(rb"[0-9a-z_\x80-\xff]+|[^0-9a-z_\x80-\xff\t\n\x0b\x0c\r ]+", data)


def grams(text):
    t = tokens(text)
    return [(x,) for x in t] + list(zip(t, t[1:]))


def bucket(gram):
    """The bucket of one n-gram, found by hashing a text of it alone."""
    found, _ = importance.gram_buckets([b" ".join(gram)])
    return int(found[-1] if len(gram) == 2 else found[0])


def test_hashing_whole_batches_equals_single_grams():
    texts = [t for _, t, _ in edge_rows() if t and len(t) < 5000]
    found, text = importance.gram_buckets([t.encode() for t in texts])
    for i, t in enumerate(texts):
        apart = Counter(found[text == i].tolist())
        # Neighbouring runs of letters and marks are tokens of their own.
        expected = Counter(bucket(g) for g in grams(t) if all(tokens(x.decode("utf-8", "ignore")) == [x] for x in g))
        assert sum(apart.values()) == len(grams(t))
        assert not expected - apart


def labels(spark):
    rows = [(100 + i, int(i % 4 != 0)) for i in range(60)] + [(17, 0), (12, 0), (None, 1), (100, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_weights_are_log_ratios_of_both_models(spark):
    got = importance.resample(edge_docs(spark), labels(spark)).collect()
    good = {100 + i for i in range(60) if i % 4 != 0}
    raw, target = Counter(), Counter()
    per_doc = []
    for d, t, _ in edge_rows():
        found, _ = importance.gram_buckets([(t or "").encode()])
        counts = Counter(found.tolist())
        raw += counts
        if d in good:
            target += counts
        per_doc.append((d, counts))
    b, nr, nt = importance.BUCKETS, sum(raw.values()), sum(target.values())
    ratio = {k: math.log((target[k] + 1) / (nt + b)) - math.log((raw[k] + 1) / (nr + b)) for k in raw}
    expected = sorted(
        (repr(d), sum(c.values()), round(sum(n * ratio[k] for k, n in c.items()), 6)) for d, c in per_doc
    )
    found = sorted((repr(r.doc_id), r.n_grams, round(r.log_weight, 6)) for r in got)
    assert [f[:2] for f in found] == [e[:2] for e in expected]
    assert [f[2] for f in found] == pytest.approx([e[2] for e in expected], abs=1e-4)


def test_greatest_keys_are_kept(spark):
    got = importance.resample(edge_docs(spark), labels(spark), share=0.5).collect()
    ordered = sorted(got, key=lambda r: r.place)
    assert [r.place for r in ordered] == list(range(len(got)))
    assert all(a.gumbel_key >= b.gumbel_key for a, b in zip(ordered, ordered[1:]))
    assert sum(r.kept for r in got) == round(len(got) / 2)
    again = importance.resample(edge_docs(spark).repartition(5), labels(spark), share=0.5).collect()
    assert sorted((repr(r.doc_id), r.kept) for r in got) == sorted((repr(r.doc_id), r.kept) for r in again)


def test_gumbel_keys_draw_in_proportion(spark):
    """Equal weights: over seeds every document is kept about as often."""
    rows = [(i, "same words in any order", "s") for i in range(10)]
    docs, none = edge_docs(spark, rows), labels(spark).limit(0)
    kept = Counter()
    for seed in range(30):
        for r in importance.resample(docs, none, share=0.5, seed=seed).where("kept").collect():
            kept[r.doc_id] += 1
    assert sum(kept.values()) == 150 and min(kept.values()) >= 6 and max(kept.values()) <= 24


def test_held_out_labels(spark):
    """Documents whose labels the model never saw are told apart."""
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    table = spark.read.parquet(f"{folder}/labels.parquet")
    seen, held = table.where("doc_id % 2 = 0"), table.where("doc_id % 2 = 1")
    rows = importance.resample(docs, seen).join(held, "doc_id").select("quality", "kept").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) >= 0.95 * len(rows)


def test_empty(spark):
    assert importance.resample(edge_docs(spark).limit(0), labels(spark)).count() == 0
