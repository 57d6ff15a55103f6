"""Spelling variants, token shards and collocations against brute force and round trips."""

import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recurra.llm import collocations as col
from recurra.llm import spelling_variants as sv
from recurra.llm import token_shards as ts
from recurra.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, n long, word string, key long"


def docs(spark, rows):
    """(doc_id, text, lang) with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, x, 7, "w", 1) for i, t, x in rows], DOCS)


# --- spelling variants ----------------------------------------------------------------------

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows, least=3):
    n = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            if len(w) >= 5:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= least}


def brute_variants(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v.encode()), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def listed(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or -1) for r in df.collect())


def odd_texts():
    rnd = random.Random(5)
    base = ["variant", "colour", "straße", "élément", "Überall", "aaaaaa", "ababab", "wording", "KelvinK"]
    rows = []
    for i in range(120):
        words = []
        for _ in range(40):
            w = rnd.choice(base)
            if rnd.random() < 0.5:
                k = rnd.randrange(len(w))
                w = rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice("abeéÀß") + w[k:], w[:k] + rnd.choice("oux") + w[k + 1:]])
            words.append(w)
        rows.append((i if i % 10 else None, rnd.choice([" ", ", ", "1", "\n"]).join(words), "x"))
    return [*rows, (1, None, "x"), (2, "", None), (3, "lengthy" * 30_000, "x"), rows[4], rows[4]]


def test_variants_equal_brute_force(spark):
    rows = odd_texts()
    n = brute_words(rows)
    assert listed(sv.spelling_variants(docs(spark, rows))) == brute_variants(n)
    counts = spark.createDataFrame(list(n.items()), "word string, n long")
    for frequent, longest in ((3, 5), (10**9, 3)):        # many long grams, none
        grams = sv.gram_dictionary(counts, frequent=frequent, max_gram=longest)
        assert listed(sv.variants(counts, dictionary=grams)) == brute_variants(n)


def test_chain_ties_and_empty(spark):
    n = {"aaaaa": 100, "aaaab": 50, "aaabb": 25, "aabbb": 12, "zzzzzx": 8, "zzzzxx": 8, "zzzzzz": 4, "ab": 9, "a": 30, "b": 60}
    counts = spark.createDataFrame(list(n.items()), "word string, n long")
    got = listed(sv.variants(counts))
    assert got == brute_variants(n)
    assert ("aabbb", "aaabb", "aaaaa", 12, 1, 25) in got           # forms are followed to the last
    assert ("zzzzzz", "zzzzzx", "zzzzzx", 4, 1, 8) in got
    assert sv.spelling_variants(docs(spark, [])).count() == 0
    assert sv.spelling_variants(docs(spark, [(1, None, None)])).count() == 0


def test_one_edit_always_meets_in_a_list():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 14))) for _ in range(400)]
    for frequent, longest in ((2, 6), (10, 4), (60, 3)):
        count = Counter(s[p:p + z] for s in map(sv.marked, words) for p in range(len(s) - 1)
                        for z in range(2, min(longest, len(s) - p) + 1))
        grams = {g: c for g, c in count.items() if len(g) == 2 or count[g[:-1]] > frequent}
        index, base = sv.GramIndex(grams), sv.GramIndex({})
        base.grams = grams
        for w in words[:150]:
            i = rnd.randrange(len(w) + 1)
            v = rnd.choice([w[:i] + "c" + w[i:], w[:i] + "e" + w[i + 1:], w[:i] + w[i + 1:]])
            if not v or not one_edit(w, v):
                continue
            assert any(a == b and abs(p - q) <= 1 for a, p in sv.merge_keys(w, index, base)
                       for b, q in sv.merge_keys(v, index, base)), (w, v)


def test_variants_of_documents(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, SF, "documents").collect()]
    assert listed(sv.spelling_variants(table(spark, SF, "documents"))) == brute_variants(brute_words(rows))


# --- token shards ---------------------------------------------------------------------------

def library(name="word_bpe_49k.json"):
    lib = Tokenizer.from_file(public_tokenizers.path(name))
    lib.no_truncation()
    lib.no_padding()
    return lib


def expected(rows, lib):
    out, at = [], 0
    for doc_id, text in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_shards_read_back_as_the_library_encodes(spark, tmp_path, name):
    odd = [(5, None), (4, ""), (3, "a <|endoftext|>, DON'T stop.́ \x1c x y ÷É, 日本 ẞΣς"), (9, "x" * 150_000),
           (8, "the cat sat. " * 20_000), (7, " \t\n"), (-1, "negative id")]
    rnd = random.Random(1)
    alpha = list("abXY ,.;:!?'<|>é×÷À́ \x85\n09ẞ") + ["<|endoftext|>", "'ll", "😀"]
    odd += [(100 + i, "".join(rnd.choice(alpha) for _ in range(60))) for i in range(150)]
    path = str(tmp_path / "shards")
    ts.write_shards(docs(spark, [(i, t, "x") for i, t in odd]), path, public_tokenizers.path(name))
    got = sorted((tuple(r) for r in ts.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(sorted(odd), library(name))
    flat = np.concatenate([library(name).encode(t or "", add_special_tokens=False).ids + [1] for _, t in sorted(odd)])
    for start, stop in ((0, 1), (13, 7000), (len(flat) - 5, len(flat) + 9), (3, 3)):
        pieces = sorted(map(tuple, ts.read_ids(spark, path, start, stop).collect()))
        assert [i for _, ids in pieces for i in ids] == flat[start:stop].tolist()


def test_shards_of_documents(spark, tmp_path):
    path = str(tmp_path / "shards")
    ts.write_shards(table(spark, SF, "documents").repartition(5), path, public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())
    got = sorted((tuple(r) for r in ts.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(rows, library())
    shards = spark.read.parquet(path).collect()
    for row in shards:
        shard = ts.Shard(bytes(row.payload))
        assert len(shard.left) > 0 and len(shard.seq) < row.n_ids
        whole = shard.expand(shard.seq)
        ends = np.cumsum(shard.counts)
        for number in (0, len(ends) // 2, len(ends) - 1):
            assert (shard.document(number) == whole[ends[number] - shard.counts[number]:ends[number]]).all()


def test_repeated_null_ids_and_empty_table(spark, tmp_path):
    rows = [(None, "one"), (None, "two words"), (2, "same"), (2, "same"), (2, "other"), (1, "first")]
    path = str(tmp_path / "a")
    ts.write_shards(docs(spark, [(i, t, "x") for i, t in rows]), path, public_tokenizers.path("word_bpe_49k.json"))
    got = sorted((tuple(r) for r in ts.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 2, 2, 2]
    assert [r[1] for r in got] == np.r_[0, np.cumsum([r[2] for r in got])][:-1].tolist()
    assert Counter(r[3] for r in got) == Counter(r[3] for r in expected(rows, library()))
    path = str(tmp_path / "b")
    ts.write_shards(docs(spark, []), path, public_tokenizers.path("word_bpe_49k.json"))
    assert ts.read_documents(spark, path).count() == 0


def test_grammar_round_trip_on_runs_and_wide_symbols():
    rnd = np.random.default_rng(3)
    for base, ids in ((50, rnd.integers(0, 4, 50_000)), (50, np.zeros(9_999, np.int64)), (70_000, rnd.integers(0, 70_000, 999)),
                      (65_535, np.tile([1, 2, 3, 65_000], 500)), (9, np.empty(0, np.int64))):
        cut = np.sort(rnd.integers(0, len(ids) + 1, 20))
        counts = np.diff(np.r_[0, cut, len(ids)])
        blob = ts.compress(ids, counts, base)
        shard = ts.Shard(blob)
        assert (shard.expand(shard.seq) == ids).all() and (shard.counts == counts).all()
        assert (shard.lengths(shard.seq).sum() if len(ids) else 0) == len(ids)
        for a, b in ((0, 5), (17, 400), (len(ids) - 3, len(ids) + 3)):
            assert (shard.ids(a, b) == ids[max(a, 0):max(b, 0)]).all()
    assert len(ts.compress(np.zeros(1 << 16, np.int64), np.array([1 << 16]), 50)) < 2000


def encoder(spec=None):
    return ts.ChunkEncoder(spec or open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_each_chunk_is_looked_up_and_encoded_once():
    """Words before marks are the same chunks as words alone, and a run of texts asks the table
    once for each distinct chunk."""
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choices("abcdeéñXY", k=rnd.randint(3, 9))) for _ in range(300)})
    marks = ["###", "$$$", "***", "&&&", "%%%", "-", ")", "_", "=", "'", ".", ""]
    texts = [" ".join(w + m for w in words) for m in marks]
    enc, sent, asked = encoder(), [], []
    library_ids, find = enc._library_ids, enc._find
    enc._library_ids = lambda chunks: sent.extend(chunks) or library_ids(chunks)
    enc._find = lambda key, spread: asked.append(key.shape[1]) or find(key, spread)
    ids, sizes = enc.encode(pa.array(texts + texts))
    chunks = len(words) + len(marks) - 1
    assert len(sent) == len(set(sent)) == chunks
    assert sum(asked) <= 3 * chunks                                  # some with other white space behind
    assert ids.tolist() == [i for t in texts + texts for i in library().encode(t, add_special_tokens=False).ids]
    assert sizes.sum() == len(ids)


@pytest.mark.parametrize("added", [None, "#x", "\u2260", "a-b", "_"])
def test_chunks_cut_before_marks_encode_as_whole_texts(added):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    if added:
        spec["added_tokens"].append({**spec["added_tokens"][0], "id": 49408, "content": added, "special": False})
    spec = json.dumps(spec)
    lib = Tokenizer.from_str(spec)
    lib.no_truncation()
    lib.no_padding()
    rnd = random.Random(5)
    alpha = [chr(c) for c in range(32, 127)] + list("aaBBéÉ×ẞ") + ["\u0338", "\u0301", "\u0307", "\u0331", "\n", "'s",
                                                                   "#x", "a-b", "a=\u0338", "<|endoftext|>", "日"]
    texts = ["".join(rnd.choices(alpha, k=rnd.randint(0, 40))) for _ in range(3000)] + [None, "", "a#", "#a", " a"]
    ids, sizes = encoder(spec).encode(pa.array(texts))
    got = [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [lib.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_commoner_of_two_pairs_has_a_shared_bucket():
    """500 places of one pair, then 20 of a pair in its bucket: the 500 are replaced."""
    def bucket(a, b):
        return (a * 0x9E3779B1 + b * 0x85EBCA6B) % (1 << 32) >> 32 - ts._BUCKETS

    a, b = next((a, b) for a in range(10, 2000) for b in range(10, 2000) if bucket(a, b) == bucket(3, 4))
    seq = np.array([x for i in range(500) for x in (3, 4, 5000 + i)] + [x for i in range(20) for x in (a, b, 6000 + i)])
    at, rule = ts._chosen(seq.astype(np.uint32), np.array([len(seq) - 1]))
    assert at.tolist() == list(range(0, 1500, 3)) and not rule.any()


def test_places_of_a_round_do_not_overlap_or_cross_documents():
    rnd = np.random.default_rng(4)
    for seq in (rnd.integers(0, 3, 4000), np.zeros(4000, int), np.repeat(rnd.integers(0, 9, 900), rnd.integers(1, 9, 900))):
        ends = np.unique(np.r_[rnd.integers(0, len(seq), 300), len(seq) - 1])
        at, rule = ts._chosen(seq.astype(np.uint32), ends)
        assert (np.diff(at) > 1).all() and not np.isin(at, ends).any() and at[-1] < len(seq) - 1
        for r in range(int(rule.max()) + 1):
            assert len({(seq[i], seq[i + 1]) for i in at[rule == r]}) == 1


# --- collocations ---------------------------------------------------------------------------

def brute_collocations(rows, least, percent=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang or "und", tuple(w[i:i + k])] += 1
    found = []
    cands = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    longest = Counter()
    for (lang, p), c in cands.items():
        if len(p) == 3:
            for part in (p[:2], p[1:]):
                longest[lang, part] = max(longest[lang, part], c)
    for (lang, p), a in cands.items():
        if len(p) == 2 and (lang, p) in longest and 100 * longest[lang, p] >= percent * a:
            continue
        score, _, left, right = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
        found.append((lang, -score, -a, " ".join(p).encode(), left, right))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrases():
    rnd = random.Random(9)
    vocabulary = ["the", "of", "New", "york", "état", "a", "É", "b c", "the"]
    rows = []
    for i in range(60):
        words = [rnd.choice(vocabulary) for _ in range(60)]
        text = "".join(w + rnd.choice([" ", " ", " ", "\t", ", ", ".\n", "\x0b", "! "]) for w in words)
        rows.append((i, text, rnd.choice(["en", "fr", None, "und"])))
    return [*rows, (1, None, "en"), (2, "", None), (3, "hot pair here " * 3000, "en"), rows[0], rows[0]]


@pytest.mark.parametrize("budget", [1 << 20, 300, 20])
def test_collocations_equal_brute_force(spark, budget):
    rows = phrases()
    got = col.collocations(docs(spark, rows).repartition(3), least=4, top=40, group_suffixes=budget)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 4, top=40)


def test_colliding_hashes_change_nothing(spark):
    rows = [(r.text, r.lang or "und") for r in docs(spark, phrases()).collect()]
    frame = spark.createDataFrame(rows, "text string, lang string")

    def named(bits):
        words, nodes = col.phrase_counts(frame, 4, group_suffixes=200, bits=bits)
        by_key = {r.key: (r.lang, r.word) for r in words.collect()}
        assert len(by_key) == words.count()
        return sorted((by_key[r.k1], by_key[r.k2], by_key.get(r.k3, ("", "")), r.a) for r in nodes.collect())
    assert named(3) == named(64)


def test_collocations_of_nothing(spark):
    assert col.collocations(docs(spark, [])).count() == 0
    assert col.collocations(docs(spark, [(1, None, None), (2, "...", "x"), (3, "one", "x")])).count() == 0


def test_scores_pass_64_bits(spark):
    big = spark.createDataFrame([(2_000_000_000_000, 3_000_000_000_000, 2_000_000_000_001)], "a long, x long, y long")
    got = big.select(col._score("a", "x", "y").alias("s")).first().s
    assert got == 1_000_000 * 2_000_000_000_000 ** 2 // (3_000_000_000_000 * 2_000_000_000_001)


def test_packed_group_round_trip():
    rnd = np.random.default_rng(1)
    for n in (1, 10, 70_000):
        keys = [rnd.integers(0, 1 << 60, n).astype(np.uint64) for _ in range(3)]
        for count in (np.ones(n, np.int64), rnd.integers(1, 1 << 40, n)):
            assert all((a == b).all() for a, b in zip(col.unpack(col.pack(*keys, count)), (*keys, count)))


def test_hot_id_is_spread(spark, tmp_path):
    """A third of all rows under one id takes more than one sorted partition."""
    frame = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
                                     F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    path = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ts.write_shards(frame, path, public_tokenizers.path("word_bpe_49k.json"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = [r for r in spark.read.parquet(path).collect() if 7 in list(r.doc_ids)]
    assert len(parts) > 1
    starts = ts.read_documents(spark, path).orderBy("start").collect()
    assert [r.start for r in starts] == np.r_[0, np.cumsum([r.n_tokens for r in starts])][:-1].tolist()
