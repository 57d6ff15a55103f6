"""Source mixing and quality rules against plain-Python versions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from recurra.llm import mixing, quality_rules

SCHEMA = "doc_id long, source string, text string, size long, row string, copies string, weight int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, "r", "c", 4) for r in rows], SCHEMA)


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share by weight again and again until nobody is above the cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        unit = rest / sum(w[s] for s in free) if free else 0
        above = [s for s in free if w[s] * unit > cap * sizes[s]]
        if not above:
            return {**fixed, **{s: w[s] * unit for s in free}}
        fixed.update({s: cap * sizes[s] for s in above})


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    names = ["b", "a", "Z", "é", "😀", None, "", "a b"][:rng.randint(1, 8)]
    rows = [(i, rng.choice(names), "w " * int(rng.paretovariate(0.6))) for i in range(60)]
    rows += [(99, "empty", ""), (100, "empty", None)]
    got = mixing.plan_copies(frame(spark, rows)).collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.row.source]
        assert r.target == pytest.approx(want[r.row.source], rel=1e-9, abs=1e-9)
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate + 1e-12) <= r.copies <= int(rate) + 1 and r.copies <= 3
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100, "d": 100}, {"a": 100, "b": 40}, {"a": 100, "b": 20, "c": 10, "d": 100, "e": 30},
    {"only": 50}, {"a": 5, "b": 2, "c": 1, "d": 5, "e": 2, "f": 1, None: 900}, {"a": 1, "b": 1, "c": 0, "d": 7}])
def test_ties_between_sources(spark, sizes):
    """Equal sizes, equal caps per weight, a single source: all sizes are shared out, none negative."""
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate(sizes.items())]
    got = {r.row.source: r for r in mixing.plan_copies(frame(spark, rows)).collect()}
    want = brute_targets(sizes)
    assert {s: r.target for s, r in got.items()} == pytest.approx(want)
    assert sum(r.target for r in got.values()) == pytest.approx(sum(sizes.values()))
    assert all(r.target >= 0 and r.copies >= 0 for r in got.values())


def test_rows_without_ids_have_coins_of_their_own(spark):
    rows = [(i if i % 3 else None, s, f"text {i} of {s} with words") for i in range(900) for s in ("a", "b")]
    got = [r for r in mixing.plan_copies(frame(spark, rows)).collect() if r.row.doc_id is None]
    taken = [r.copies - int(r.target / r.source_size) for r in got if r.row.source == "b"]
    rate = got[0].target / got[0].source_size
    assert 0 < sum(taken) < len(taken) and len(got) == 600 and rate > 0


def test_mix_emits_the_copies_and_reruns_agree(spark):
    rows = [(i, f"s{i % 4}", "one two three " * (i % 7 + 1)) for i in range(400)]
    docs = frame(spark, rows)
    planned = {r.row.doc_id: r.copies for r in mixing.plan_copies(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    seen = {}
    for r in mixed.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: v for k, v in planned.items() if v}
    again = {r.row.doc_id: r.copies for r in mixing.plan_copies(docs.repartition(5)).collect()}
    assert again == planned
    taken = mixing.plan_copies(docs).groupBy("row.source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("t"), F.first("target").alias("target")).collect()
    # independent coins: within 4 standard deviations (sizes 3..21 words, 100 documents a source)
    assert all(abs(r.t - r.target) < 4 * 0.5 * (100 * 13.5 ** 2) ** 0.5 for r in taken)


def test_mix_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = [(i, f"s{i % 9}", "w " * (i % 5)) for i in range(90)]
    want = sorted((r.row.doc_id, r.copies) for r in mixing.plan_copies(frame(spark, rows)).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    assert sorted((r.row.doc_id, r.copies) for r in mixing.plan_copies(frame(spark, rows)).collect()) == want


def test_mix_edges(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, None, None), (None, None, "a b"), (1, None, "a b"), (1, None, "a b")]
    got = mixing.plan_copies(frame(spark, rows)).collect()
    assert {(r.source_size, r.target, r.copies) for r in got} == {(6, 6.0, 1)}


def brute_measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    return dict(n_words=len(w), word_chars=sum(map(len, w)), n_symbols=sum(t.count(c) for c in "#*$%&|<>"),
                n_lines=len(lines), n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(covered),
                n_upper=len(re.findall("[A-Z]", t)), n_letters=len(re.findall("[A-Za-z]", t)))


def test_measures_match_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", " \t\n", "a", "a b c d", "a b c d e", "a " * 9, "x y z u v x y z u v", "é😀 ü|<#\n\né😀 ü|<#",
             "l\r\nl\nl \nl", "Der " * 300, "SHOUT!! " * 20, "\x0b\x0ca\x0db"]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 80))).replace("b c", "b\nc") for _ in range(60)]
    texts += [texts[7], texts[7]]
    docs = frame(spark, [(i, "s", t) for i, t in enumerate(texts)] + [(None, "s", "a b")])
    got = quality_rules.ledger(docs).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        want = brute_measures("a b" if r.doc_id is None else texts[r.doc_id])
        assert {k: r[k] for k in want} == want
        base = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert base == bool(r.failed_bits & quality_rules.BASE.mask)


def test_policies_and_ablation_come_from_the_bits(spark):
    texts = ["Der " * 30, "ok " + " ".join(f"w{i}" for i in range(20)), "a|b " * 3, "few", "### " * 4]
    led = quality_rules.ledger(frame(spark, [(i, "s", t) for i, t in enumerate(texts)]))
    kept = {r.doc_id for r in quality_rules.apply_policy(led).collect() if r.kept}
    assert kept == {1}
    table = {r.rule: r for r in quality_rules.ablation(led).collect()}
    bits = [r.failed_bits for r in led.collect()]
    for i, rule in enumerate(quality_rules.RULES):
        assert table[rule].n_failed == sum(bool(b >> i & 1) for b in bits)
        assert table[rule].n_only == sum(b == 1 << i for b in bits)
        assert table[rule].n_docs == len(bits)


def test_keep_passing_keeps_rows_whole(spark):
    good = " ".join(f"w{i}" for i in range(30))
    docs = frame(spark, [(1, "s", good), (1, "s", good), (2, "s", "few"), (None, None, None)])
    kept = quality_rules.keep_passing(docs)
    assert kept.columns == docs.columns
    assert [tuple(r) for r in kept.collect()] == [(1, "s", good, 9, "r", "c", 4)] * 2
    assert quality_rules.keep_passing(docs.limit(0)).count() == 0


def test_filter_on_measures_is_not_pushed_below_them(spark):
    led = quality_rules.ledger(frame(spark, [(1, "s", "x " * 30)])).filter("failed_bits = 0 and n_words > 3")
    plan = led._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")
