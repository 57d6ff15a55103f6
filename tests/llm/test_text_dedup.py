"""Exact dedup, near dedup and repeated-span removal against brute force."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recurra.llm import dart_minhash, exact_dedup, suffix_dedup
from recurra.llm.common import keep_rows

SCHEMA = "doc_id long, text string, size long, row string, key string, n long"


def frame(spark, rows, parts=3):
    full = [(i, t, 1, "x", "y", 2) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# --- exact dedup ----------------------------------------------------------------------------

def test_equal_groups_match_brute_force(spark):
    rng = random.Random(4)
    texts = ["a  b", "a b", "a\t\nb", " a b", "", None, "é" * 70 + "x", "é" * 70 + "y", "z" * 5000]
    rows = [(i, rng.choice(texts)) for i in range(400)] + [(7, "a b"), (7, "a b"), (None, "a b"), (None, None)]
    got = exact_dedup.equal_groups(frame(spark, rows, 8)).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    assert len(got) == len(rows)
    kept = {}
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        ids = groups[text]
        assert r.keep_id == min(i for i in ids if i is not None)
        assert r.group_size == len(ids)
        kept[text] = kept.get(text, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_group_that_fills_partitions_is_put_together(spark):
    rows = [(i, "the same text") for i in range(3000)] + [(5000 + i, f"other {i}") for i in range(40)]
    got = exact_dedup.equal_groups(frame(spark, rows, 6)).collect()
    assert {r.keep_id for r in got if r.doc_id < 3000} == {0}
    assert {r.group_size for r in got if r.doc_id < 3000} == {3000}
    assert sum(r.kept for r in got) == 41


def test_drop_copies_keeps_columns_and_one_of_repeated_rows(spark):
    docs = frame(spark, [(1, "a b"), (1, "a b"), (2, "a  b"), (3, None), (4, ""), (None, "q")])
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("1", "a b"), ("3", None), ("None", "q")]


def test_exact_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.equal_groups(empty).count() == 0
    assert exact_dedup.drop_copies(empty).count() == 0


# --- near dedup -----------------------------------------------------------------------------

def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute_classes(rows, threshold=0.8):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    out = {}
    for i in range(len(rows)):
        out.setdefault(find(i), []).append(rows[i][0])
    return sorted(sorted(c) for c in out.values())


def make_corpus(seed, n_bases=25):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(n_bases):
        base = [rng.choice(vocab) for _ in range(rng.randint(3, 200))]
        for _ in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 6, 12])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
            i += 1
    return rows


def test_near_duplicate_classes_match_brute_force(spark):
    rows = make_corpus(1) + [(900, None), (901, ""), (902, "one"), (903, "one"), (904, " \t")]
    got = dart_minhash.near_duplicates(frame(spark, rows)).collect()
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    assert sorted(sorted(c) for c in classes.values()) == brute_classes(rows)
    assert all(k == min(c) for k, c in classes.items())
    assert {r.doc_id for r in got if r.kept} == set(classes)
    assert all(r.class_size == len(classes[r.class_id]) for r in got)


def test_chain_of_near_copies_is_one_class(spark):
    """Members far from the pivot are found through the blocks of stragglers."""
    words = [f"a{i}" for i in range(300)]
    rows = []
    for k in range(40):
        rows.append((k, " ".join(words)))
        words = words[4:] + [f"b{k}_{j}" for j in range(4)]
    got = dart_minhash.near_duplicates(frame(spark, rows)).collect()
    assert {r.class_id for r in got} == {0}


def test_near_repeated_rows_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = frame(spark, [(5, long), (5, long), (None, long + " x"), (9, "other words here and there now")])
    got = dart_minhash.near_duplicates(docs).collect()
    assert sorted(str(r.class_id) for r in got) == ["5", "5", "5", "9"]
    kept = dart_minhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 9]


def family(n, unique, seed):
    """Texts of one template, each with some sentences of its own: similarity just under or over 0.8."""
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(200)]
    return [(i, " ".join(base + [f"u{i}_{k}" for k in range(unique + rng.randint(0, 1))])) for i in range(n)]


def test_family_just_under_the_threshold_matches_brute_force(spark):
    rows = family(120, 24, 3) + [(500 + i, t) for i, t in family(60, 20, 4)]
    got = {}
    for r in dart_minhash.near_duplicates(frame(spark, rows)).collect():
        got.setdefault(r.class_id, []).append(r.doc_id)
    assert sorted(map(sorted, got.values())) == brute_classes(rows)


def test_large_clusters_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(dart_minhash, "BLOCK", 16)
    rows = family(90, 24, 5) + make_corpus(6, 8)[:30]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    got = {}
    for r in dart_minhash.near_duplicates(frame(spark, rows)).collect():
        got.setdefault(r.class_id, []).append(r.doc_id)
    assert sorted(map(sorted, got.values())) == brute_classes(rows)


@pytest.mark.parametrize("n", [40, 80, 160])
def test_rows_of_a_family_grow_with_its_texts(spark, monkeypatch, n):
    """A family just under the threshold: no table has more rows than texts times bands."""
    most = []
    plain = dart_minhash.stored

    def counting(df):
        out = plain(df)
        most.append(out.count())
        return out
    monkeypatch.setattr(dart_minhash, "stored", counting)
    dart_minhash.near_duplicates(frame(spark, family(n, 24, 7))).count()
    assert max(most) <= n * dart_minhash.BANDS


def test_exact_links_are_the_pairs_that_reach_the_threshold():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 25))).astype(np.uint64) for _ in range(60)]
    raw = [x.tobytes() for x in sets]
    left, right = np.arange(0, 35), np.arange(20, 60)
    want = {(i, j) for i in left for j in right if len(np.intersect1d(sets[i], sets[j])) >= 0.5 * len(np.union1d(sets[i], sets[j]))}
    assert set(dart_minhash.exact_links(raw, left, right, 0.5)) == want


def test_near_empty_table(spark):
    assert dart_minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_loses_no_more_links_than_the_bands():
    k, chance = dart_minhash.K, 2.0 ** -dart_minhash.BITS
    agree = 0.8 + 0.2 * chance
    least = dart_minhash._least_estimate(0.8)
    lost = sum(math.comb(k, n) * agree ** n * (1 - agree) ** (k - n) for n in range(k + 1)
               if (n / k - chance) / (1 - chance) < least)
    assert lost <= (1 - agree ** dart_minhash.ROWS) ** dart_minhash.BANDS


def test_equal_sets_with_different_counts_are_apart_by_count(spark):
    cycle = "one two three four five six "
    rows = [(1, cycle * 3), (2, cycle * 60), (3, cycle * 60 + " ")]       # the same six shingles
    by_set = dart_minhash.near_duplicates(frame(spark, rows)).collect()
    by_count = dart_minhash.near_duplicates(frame(spark, rows), weighting="count").collect()
    assert {r.doc_id: r.class_id for r in by_set} == {1: 1, 2: 1, 3: 1}
    assert {r.doc_id: r.class_id for r in by_count} == {1: 1, 2: 2, 3: 2}


def test_dart_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    element = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
    wa = rng.integers(0, 6, 400).astype(float)
    wb = np.where(rng.random(400) < 0.3, rng.integers(0, 6, 400), wa).astype(float)
    wa[:3], wb[:3] = 0.4, 0.9
    doc = np.repeat([0, 1], 400)
    keep = np.r_[wa, wb] > 0
    sig = dart_minhash.dart_signatures(doc[keep], np.r_[element, element][keep], np.r_[wa, wb][keep], 2, 4096)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 0.04


def test_dart_signatures_do_not_depend_on_the_batch():
    texts = [f"alpha beta gamma {i} " * (i + 1) for i in range(20)] + ["", "x"]
    doc, sh, w = dart_minhash.text_shingles(pa.array(texts))
    whole = dart_minhash.dart_signatures(doc, sh, w, len(texts))
    for i, t in enumerate(texts):
        d, s, v = dart_minhash.text_shingles(pa.array([t]))
        assert (dart_minhash.dart_signatures(d, s, v, 1)[0] == whole[i]).all()


# --- repeated spans -------------------------------------------------------------------------

def brute_cut(rows):
    first = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        if i is not None:
            for k in range(len(b) - 49):
                s = b[k:k + 50]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        if i is not None:
            for k in range(len(b) - 49):
                if first[b[k:k + 50]] < i:
                    gone[k:k + 50] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((str(i), len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out)


def check_cut(spark, rows, parts=3):
    got = suffix_dedup.cut_repeats(frame(spark, rows, parts)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_cut(rows)


def test_cut_matches_brute_force(spark):
    rng = random.Random(8)
    rows = make_corpus(2, 12)
    passage = " ".join(f"p{rng.randint(0, 99)}" for _ in range(40))
    for i in range(300, 340):                       # a shared passage at many places
        left, right = ("".join(rng.choice("abc é") for _ in range(rng.randint(0, 120))) for _ in range(2))
        rows.append((i, left + passage[rng.randint(0, 20):rng.randint(60, len(passage))] + right))
    rows += [(400, "Der " * 200), (401, "xDer " * 90 + "Der " * 60), (402, "a" * 700), (403, "a" * 49),
             (404, "a" * 50), (405, None), (406, ""), (None, passage), (300, passage + "!"), (300, passage + "!")]
    check_cut(spark, rows)


def test_cut_with_hot_grams(spark, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(suffix_dedup, "HOT_BLOCKS", 3)
    passage = "the one passage that very many documents share, word for word, all along"
    rows = [(i, "".join(rng.choice("xyz ") for _ in range(30)) + passage + "".join(rng.choice("uvw ") for _ in range(30)))
            for i in range(60)]
    check_cut(spark, rows)


def test_cut_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(10)
    body = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    monkeypatch.setattr(suffix_dedup, "LONG_PIECE", 1000)
    whole = suffix_dedup.blocks(pa.array([body]))
    assert whole[2].sum() == len(body) - 49          # every window belongs to one block
    monkeypatch.undo()
    check_cut(spark, [(1, body), (2, body[3000:7000] + "!" + body[:500])])


def test_cut_empty_table(spark):
    assert suffix_dedup.cut_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=60, max_size=400).map(lambda b: bytes(x % 3 + 97 for x in b)), st.randoms())
def test_deep_shallow_order(data, rng):
    data = data + data[:100]
    start = np.array([rng.randrange(len(data) - 50) for _ in range(80)])
    order, group = suffix_dedup.deep_shallow_groups(np.frombuffer(data + bytes(60), np.uint8), start)
    cut = [data[start[i]:start[i] + 50] for i in order]
    assert cut == sorted(cut)
    assert [a == b for a, b in zip(cut, cut[1:])] == (np.diff(group) == 0).tolist()


def test_keep_rows_without_decisions(spark):
    docs = frame(spark, [(1, "a")])
    none = spark.createDataFrame([], "doc_id long, text_sha string, kept boolean")
    assert keep_rows(docs, none).count() == 0


@pytest.mark.parametrize("long", [1, 200_000])
def test_one_very_long_text(spark, long):
    docs = frame(spark, [(1, "word " * long), (2, "word " * long)])
    assert [r.group_size for r in exact_dedup.equal_groups(docs).collect()] == [2, 2]
    assert {r.class_id for r in dart_minhash.near_duplicates(docs).collect()} == {1}
