import re
from collections import Counter

import pytest
from cases import edge_docs, edge_rows, words

from lapwise.llm import quality_rules


def features(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if windows[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [s for s in (text or "").split("\n") if words(s)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


def test_features_and_base_rule(spark):
    got = quality_rules.score(edge_docs(spark)).collect()
    expected = sorted(
        (repr(d), *features(t)) for d, t, _ in edge_rows()
    )
    assert sorted(
        (repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        for r in got
    ) == expected
    for r in got:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed
        assert not (failed and r.kept)


def posterior_by_hand(patterns, weights, rounds=40):
    import math

    rules = quality_rules
    n = len(rules.RULES)
    prior, good, bad = rules.GOOD_SHARE, [rules.GOOD_RIGHT] * n, [rules.BAD_FOUND] * n

    def judge(p):
        odds = math.log(prior / (1 - prior))
        for vote, a, b in zip(p, good, bad):
            odds += {"+": math.log(a / (1 - b)), "-": math.log((1 - a) / b), "0": 0}[vote]
        return 1 / (1 + math.exp(-odds))

    for _ in range(rounds):
        q = {p: judge(p) for p in patterns}
        fresh_good, fresh_bad = [], []
        for j in range(n):
            cast = [(p, weights[p]) for p in patterns if p[j] != "0"]
            a = (sum(c * q[p] for p, c in cast if p[j] == "+") + rules.BELIEF * rules.GOOD_RIGHT) / (
                sum(c * q[p] for p, c in cast) + rules.BELIEF
            )
            b = (sum(c * (1 - q[p]) for p, c in cast if p[j] == "-") + rules.BELIEF * rules.BAD_FOUND) / (
                sum(c * (1 - q[p]) for p, c in cast) + rules.BELIEF
            )
            a = min(0.9999, max(0.5, a))
            fresh_good.append(a)
            fresh_bad.append(min(0.9999, max(0.0001, 1 - a, b)))
        total = max(sum(weights[p] for p in patterns), 1)
        prior = min(0.99, max(0.05, sum(weights[p] * q[p] for p in patterns) / total))
        good, bad = fresh_good, fresh_bad
    return {p: judge(p) for p in patterns}


def test_posterior_is_that_of_expectation_maximisation(spark):
    got = quality_rules.score(edge_docs(spark)).collect()
    expected = posterior_by_hand(
        {r.pattern for r in got}, Counter(r.pattern for r in got if not r.base_failed)
    )
    for r in got:
        assert r.posterior == pytest.approx(expected[r.pattern], rel=1e-9)
        assert r.kept == (not r.base_failed and expected[r.pattern] >= 0.5)


def test_evidence_is_weighed(spark):
    """Documents kept against a bad vote, and dropped although more rules call them good."""
    import os

    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    scored = quality_rules.score(spark.read.parquet(f"{folder}/documents.parquet")).where("not base_failed")
    counts = {(r.pattern, r.kept): r["count"] for r in scored.groupBy("pattern", "kept").count().collect()}
    against = sum(n for (p, kept), n in counts.items() if kept and "-" in p)
    outvoted = sum(n for (p, kept), n in counts.items() if not kept and p.count("+") > p.count("-"))
    assert against >= 20 and outvoted >= 100
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scored.join(labels, "doc_id").select("quality", "kept", "pattern").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) >= 0.998 * len(rows)
    # Where a single accusation was overruled, that was right.
    overruled = [r.quality for r in rows if r.kept and "-" in r.pattern]
    assert overruled and sum(overruled) >= 0.95 * len(overruled)


def test_symbols_go_and_prose_stays(spark):
    kept = {r.doc_id: r.kept for r in quality_rules.score(edge_docs(spark)).collect()}
    assert not kept[17] and not kept[12]
    assert all(kept[100 + i] for i in range(60))


def test_filter_keeps_columns_and_whole_rows(spark):
    docs = edge_docs(spark)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    verdict = {
        (r.doc_id, r.n_words, r.word_chars): r.kept for r in quality_rules.score(docs).collect()
    }
    expected = sorted(
        (repr(d), repr(t)) for d, t, _ in edge_rows() if verdict[(d, *features(t)[:2])]
    )
    got = kept.toDF(*[f"c{i}" for i in range(len(docs.columns))]).collect()
    assert sorted((repr(r.c0), repr(r.c1)) for r in got) == expected


def test_main_path_runs_no_python(spark):
    plan = quality_rules.score(edge_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    docs = edge_docs(spark).limit(0)
    assert quality_rules.score(docs).count() == 0
    assert quality_rules.keep_good(docs).count() == 0


def test_labels_agree(spark):
    """Accuracy against the labels of the test tables, which the rules never see."""
    import os

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality_rules.score(spark.read.parquet(f"{folder}/documents.parquet"))
    rows = scored.join(labels, "doc_id").select("quality", "kept", "base_failed").collect()
    judged = [r for r in rows if not r.base_failed]
    assert sum(r.kept == (r.quality == 1) for r in judged) >= 0.97 * len(judged)
