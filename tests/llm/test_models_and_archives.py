"""Tokeniser, quality voting, URL filter, license scan and revisits."""

import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recurra.llm import bpe, knn_quality, license_scan, revisits, url_filter
from recurra.llm.common import table
from recurra.llm.queries import token_digests

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


# --- BPE ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe(bpe.read_vocabulary(PATH))


def agree(library, own, texts):
    want = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    got = own.encode_column(pa.array(texts, pa.string()))
    assert got.to_pylist() == [w.ids for w in want]
    back = own.decode_column(got).to_pylist()
    assert back == [library.decode(w.ids, skip_special_tokens=False) for w in want]


def test_bpe_edges(library, own):
    agree(library, own, [None, "", " \n\t", "Hello, World! it's 2024's", "a" * 5000, "!" * 3000, "xY" * 4000,
                         "<|startoftext|>a<|endoftext|>", "<|endoftext|", "ΣΑΣ ΟΔΟΣ", "İstanbul ẞ", "e\u0301 \u00e9",
                         "a\x1cb\x1db c\x85d\u3000e", "語中文 👍🏽 #$%^", "can't we'll I'd they've", "x\u200by\ufeff"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abthe inging'srvelmd ABΣé ß\n\t1290!?.,$<|startofx>語中👍\u0301"),
                        max_size=120), max_size=6))
def test_bpe_random(library, own, texts):
    agree(library, own, texts)


def test_bpe_forgets_and_goes_on(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 500)
    small = bpe.WordBpe(bpe.read_vocabulary(PATH))
    for text in ("one two three four five", "five six one two", "seven eight nine"):
        agree(library, small, [text])


def test_forced_cuts_are_pairs_of_no_token(own):
    ids, count = own.encode_words([b"zqxj"])
    assert count.tolist() == [len(ids)]
    cut = [(a, b) for a, b in itertools.product(range(256), repeat=2) if not own.inner[a, b]]
    tokens = [t.removesuffix("</w>") for t in own.tokens[:49406]]
    units = bpe.byte_units()
    for a, b in random.Random(1).sample(cut, 200):
        assert not any(units[a] + units[b] in t[:-1] for t in tokens)


def test_bpe_columns(spark, library):
    docs = spark.createDataFrame([(1, "Hello there", "x"), (2, None, "y"), (3, "", "z"), (1, "Hello there", "x")],
                                 "doc_id long, text string, ids_ string")
    coded = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    want = library.encode("Hello there", add_special_tokens=False)
    assert [list(r.ids) for r in coded if r.doc_id == 1] == [want.ids] * 2
    assert {r.decoded for r in coded if r.doc_id == 1} == {library.decode(want.ids, skip_special_tokens=False)}
    assert [(r.ids, r.decoded) for r in coded if r.doc_id != 1] == [([], ""), ([], "")]
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_bpe_on_documents(spark, library):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.encode(docs, PATH).collect():
        assert list(r.ids) == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids


def test_bpe_round_trip_is_decode_of_encode(spark):
    rows = [(1, "Hello there", "x", 5), (None, None, "y", 6), (3, "", "z", 7), (1, "Hello there", "x", 5),
            (4, "<|endoftext|>a \u0130stanbul " * 400, "w", 8), (5, "\x1c \u3000", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, both long").repartition(2)
    got, want = bpe.round_trip(docs, PATH), bpe.decode(bpe.encode(docs, PATH), PATH)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0


def test_token_digests_run_one_python_worker_a_core(spark):
    docs = spark.createDataFrame([(1, "Hello there")], "doc_id long, text string")
    plan = token_digests(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


@pytest.mark.parametrize("whole", [True, False])
def test_bpe_task_leaves_no_chunks(whole):
    bundle = type("Sent", (), {"value": bpe.read_vocabulary(PATH)})
    out = bpe._by_batch(PATH, bundle, bpe._both)(iter([pa.array(["one two three", None]), pa.array(["four"])]))
    assert len(next(out)) == 2
    model = bpe._model(PATH, bundle)
    assert model.held > 0
    if whole:
        assert [len(x) for x in out] == [1]
    else:
        out.close()
    assert (model.held, len(model.cache), len(model.flat)) == (0, 0, 0)


# --- quality voting ---------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = {r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    train = labels.filter(~labels.doc_id.isin(list(held)))
    scored = {r.doc_id: r for r in knn_quality.score_quality(docs, knn_quality.train(docs, train)).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    right = [scored[d].predicted == truth[d] for d in held]
    assert np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored.values())


def test_voting_edges(spark):
    docs = spark.createDataFrame([(1, "good words here", 0.5), (2, "### $$$ !!!", 0.5), (3, None, 0.5), (4, "", 0.5),
                                  (None, "good words", 0.5), (1, "good words here", 0.5)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 0), (None, 1, 0), (8, None, 0), (9, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    voter = knn_quality.train(docs, labels)
    assert len(voter.labels) == 2
    got = knn_quality.score_quality(docs, voter).collect()
    assert len(got) == 6
    by = {r.doc_id: r.score for r in got}
    assert by[3] == by[4] == pytest.approx(0.5) and by[1] > by[2]
    nothing = knn_quality.train(docs, labels.limit(0))
    assert {r.score for r in knn_quality.score_quality(docs, nothing).collect()} == {0.5}
    assert knn_quality.score_quality(docs.limit(0), voter).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    assert len(knn_quality.train(docs, labels, max_labelled=10).labels) == 10


def test_votes_are_exact_neighbours():
    rng = np.random.default_rng(1)
    counts = rng.poisson(1.0, (60, knn_quality.N_TERMS)).astype(np.float32)
    voter = knn_quality.fit_voter(counts, (np.arange(60) % 3 > 0).astype(float), neighbours=5)
    vec = voter.embed(counts)
    for i, got in enumerate(voter.score(counts)):
        sim = vec[i] @ voter.vectors.T
        near = np.argsort(-sim)[:5]
        w = np.maximum(sim[near], 0).astype(float) ** 8
        p = knn_quality.PRIOR_WEIGHT
        assert got == pytest.approx((w @ voter.labels[near] + p * voter.labels.mean()) / (w.sum() + p), abs=1e-5)


# --- URLs -------------------------------------------------------------------------------------

def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(r), r, v) for v, r in url_filter.RULES
           if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
           and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, *(max(fit)[1:] if fit else (None, None))


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "HTTP://net/", "http://x.net", "http://xnet/a",
            "https://example.com/de/1#t", "https://a.example.com/de", "ftp://É.org/fr/ü?q", "a://b://c/d", "http://x.org?/fr/",
            "http://x.org#/fr/", "x" * 200_000, "http://h/" + "p" * 100_000, "http://example.net/en", "http://sub.org/fr/a\nb"]
    rows = [(i, u, "clash") for i, u in enumerate(urls)] + [(4, urls[4], "clash")]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string"),
                                url_filter.train(spark)).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = brute_url(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.block_score >= 0.5 else "allow"))
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"), url_filter.train(spark)).count() == 0


def test_held_out_hosts_of_the_labelled_table(spark):
    accuracy, margin = url_filter.holdout_accuracy(spark)
    print(f"held-out accuracy {accuracy:.3f}, mean distance from the threshold {margin:.3f}")
    assert accuracy >= 0.9 and margin >= 0.1
    table = url_filter.labelled_urls(spark).collect()
    assert len({r.url for r in table}) == len(table) and 0.2 < np.mean([r.held_out for r in table]) < 0.3


def test_model_of_a_callers_table_is_bounded_and_repeatable(spark, monkeypatch):
    table = spark.createDataFrame([(f"http://{w}{i}.org/", float(w == "bad")) for i in range(30) for w in ("bad", "fine")],
                                  "url string, label double").repartition(7)
    urls = spark.createDataFrame([(0, "http://bad77.com/"), (1, "http://fine78.com/")], "page_id long, url string")
    first, again = ([r.block_score for r in url_filter.judge_urls(urls, url_filter.train(spark, t), rules=()).orderBy("page_id").collect()]
                    for t in (table, table.repartition(3)))
    assert first == again and first[0] > 0.5 > first[1]
    monkeypatch.setattr(url_filter, "MAX_LABELLED", 10)
    assert url_filter.train(spark, table) is not None


def test_rules_of_equal_length_are_ordered_by_text(spark):
    urls = spark.createDataFrame([(0, "http://a.b/xy")], "page_id long, url string")
    for rules in ((("block", "b/xy"), ("allow", "a.b/")), (("allow", "a.b/"), ("block", "b/xy"))):
        got = url_filter.judge_urls(urls, url_filter.train(spark), rules=rules).first()
        assert (got.rule, got.verdict) == ("a.b/", "allow")


# --- licenses ---------------------------------------------------------------------------------

def brute_licenses(text, containment=0.8):
    def words(t):
        return re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))

    w = words(text)
    mine = {tuple(w[i:i + 3]) for i in range(len(w) - 2)}
    out = set()
    for name, t in license_scan.TEMPLATES.items():
        v = words(t)
        want = {tuple(v[i:i + 3]) for i in range(len(v) - 2)}
        if len(want & mine) >= containment * len(want):
            out.add(name)
    return out


def test_licenses_are_found_wherever_they_stand(spark):
    rng = random.Random(6)
    filler = [f"word{i}" for i in range(500)]
    texts = [None, "", "Licensed", "no license at all " * 50]
    for name, t in license_scan.TEMPLATES.items():
        for n in (0, 7, 31, 150):
            left, right = ([rng.choice(filler) for _ in range(rng.randint(0, n))] for _ in range(2))
            texts.append(" ".join([*left, t.upper() if n == 7 else t, *right]))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, template string")
    got = {}
    for r in license_scan.scan_licenses(docs).collect():
        got.setdefault(r.doc_id, set()).add(r.template)
        assert 0.8 <= r.containment <= 1 and 0 <= r.first_byte < r.end_byte <= len(texts[r.doc_id].encode())
    assert got == {i: brute_licenses(t) for i, t in enumerate(texts) if brute_licenses(t)}
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0


def test_repeated_notices_stray_shingles_and_spans(spark):
    apache, mit = (license_scan.TEMPLATES[n] for n in ("Apache-2.0", "MIT"))
    filler = "some words of another kind that say nothing of any terms at all "
    stray = "the Apache License came first. "
    texts = [apache + " " + apache + " " + apache, filler + apache + " " + filler * 30 + apache, stray + apache,
             f"{filler}{mit} {filler * 3}{stray}{apache} {filler}", license_scan.TEMPLATES["GPL-3.0-notice"] * 2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in license_scan.scan_licenses(docs).orderBy("doc_id", "first_byte").collect():
        got.setdefault((r.doc_id, r.template), []).append((r.first_byte, r.end_byte))

    def spans(text, notice):
        notice = notice.rstrip(".")
        return [(m.start(), m.end()) for m in re.finditer(re.escape(notice), text)]
    for i, text in enumerate(texts[:4]):
        assert got[i, "Apache-2.0"] == spans(text, apache)
    assert got[3, "MIT"] == spans(texts[3], mit)
    assert len(got[4, "GPL-3.0-notice"]) == 2


def test_dense_spans_match_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        which = [rng.randrange(5) for _ in range(rng.randint(0, 14))]
        place = sorted(rng.sample(range(60), len(which)))

        def brute(lo, hi):
            need = len(set(which[lo:hi]))
            if need < 4:
                return []
            a, b = min(((a, b) for a in range(lo, hi) for b in range(a, hi) if len(set(which[a:b + 1])) == need),
                       key=lambda x: (place[x[1]] - place[x[0]], x[1]))
            return brute(lo, a) + [(need, place[a], place[b])] + brute(b + 1, hi)
        assert license_scan.dense_spans(place, which, 4) == brute(0, len(which))


def test_license_windows_are_those_of_every_width(monkeypatch):
    matcher = license_scan.Matcher(license_scan.TEMPLATES, 0.8)
    rng = np.random.default_rng(5)
    many = [1, 2, 7, 8, 9, 15, 16, 17, 300, 1000, 4099]
    doc, h, _, _ = license_scan.word_hashes(pa.array([" ".join(f"w{x}" for x in rng.integers(0, 50, n)) for n in many]))
    sh = license_scan.runs(doc, h)
    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    want = set()
    for b, n in zip(begin.tolist(), many):
        for width in matcher.keys:
            step = width // 2
            want |= {(width, b + k * step, min(b + k * step + width, b + n)) for k in range(max(1, -(-n // step) - 1))}
    for tile in (1, 512, 1 << 15):
        monkeypatch.setattr(license_scan, "TILE", tile)
        got = set()
        for at, to in matcher.tiles(begin, np.array(many)):
            for width, first, last, sig in matcher.windows(sh, at, to):
                got |= set(zip([width] * len(first), first.tolist(), last.tolist()))
                for f, z, row in zip(first, last, sig):
                    assert (row == license_scan.signatures(sh, np.array([f]), np.array([z]))[0]).all()
        # stretches of one text that overlap add only windows that end with a stretch
        assert want <= got
        if tile == 1 << 15:
            assert want == got


def test_licenses_of_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {}
    for r in license_scan.scan_licenses(docs).collect():
        got.setdefault(r.doc_id, set()).add(r.template)
    want = {r.doc_id: brute_licenses(r.text) for r in docs.collect()}
    assert got == {d: t for d, t in want.items() if t}


# --- revisits ---------------------------------------------------------------------------------

REC = "record_id string, url string, date long, status int, headers map<string,string>, extra string"


def test_canonical_urls(spark):
    cases = {"HTTP://WWW.Example.com:80/a/?utm_source=x#top": "example.com/a", "https://example.com/a": "example.com/a",
             "https://m.example.com/a?b=2&a=1&ref=x": "m.example.com/a?a=1&b=2", "": "", None: "",
             "https://example.com": "example.com", "http://x.org/?q=1": "x.org?q=1"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "u string, want string")
    assert all(r.got == r.want for r in df.select("want", revisits.canonical_url(df.u).alias("got")).collect())


def brute_revisits(rows):
    out = {}
    full = sorted(((r[2] is not None, r[2] or 0, r[0], r[5], r[4] or {}) for r in rows if r[3] == 200))
    for rid, _, date, status, headers, key in rows:
        if status != 304:
            continue
        h = headers or {}
        before = [f for f in full if f[3] == key and (f[0], f[1]) <= (date is not None, date or 0)]
        if not before:
            out[rid] = (None, "no_original", h)
            continue
        _, _, oid, _, stored = before[-1]
        tag = [x.get("etag", "").removeprefix("W/") for x in (h, stored)]
        mod = [x.get("last-modified", "") for x in (h, stored)]
        agree = tag[0] == tag[1] if all(tag) else mod[0] == mod[1] if all(mod) else None
        if agree is False:
            out[rid] = (oid, "validator_mismatch", h)
        else:
            news = {k: v for k, v in h.items() if k not in revisits.NOT_MERGED}
            out[rid] = (oid, "unchecked" if agree is None else "resolved", {**stored, **news})
    return out


def test_revisits_match_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        url = rng.choice([None, "http://hot.org/a", "http://hot.org/a", "http://hot.org/a/", f"http://x{i % 40}.org/p"])
        h = rng.choice([None, {}, {"etag": rng.choice(['"a"', 'W/"a"', '"b"']), "content-length": "5", "x": str(i)},
                        {"last-modified": rng.choice(["m", "n"]), "date": str(i)}])
        rows.append((f"r{i:04d}", url, rng.choice([None, *range(300)]), rng.choice([200, 304, 304, 404]), h, "e"))
    docs = spark.createDataFrame(rows, REC).repartition(7)
    keys = {None: "", "http://hot.org/a": "hot.org/a", "http://hot.org/a/": "hot.org/a"}
    want = brute_revisits([(*r[:5], keys.get(r[1], (r[1] or "").removeprefix("http://"))) for r in rows])
    got = {r.record_id: (r.original_id, r.outcome, r.headers) for r in revisits.resolve(docs).collect()}
    assert got == want


def test_revisit_edges(spark):
    assert revisits.resolve(spark.createDataFrame([], REC)).count() == 0
    only = [("a", "http://x/", 1, 304, None, "e"), ("a", "http://x/", 1, 304, None, "e"), ("b", None, None, None, None, "e")]
    got = revisits.resolve(spark.createDataFrame(only, REC)).collect()
    assert [(r.record_id, r.outcome) for r in got] == [("a", "no_original")]


def test_revisits_with_repeated_and_null_ids(spark):
    rows = [("full", "http://a.org/", 1, 200, {"etag": '"a"', "x": "a"}, "e"),
            ("full", "http://b.org/", 1, 200, {"etag": '"b"', "x": "b"}, "e"),
            (None, "http://c.org/", 1, 200, {"etag": '"c"', "x": "c"}, "e"),
            *[(rid, f"http://{host}.org/", 2, 304, {"etag": f'"{host}"'}, "e")
              for rid in ("again", None) for host in "abcd"],
            (None, "http://d.org/", 2, 304, {"etag": '"d"'}, "e")]
    got = revisits.resolve(spark.createDataFrame(rows, REC).repartition(5)).collect()
    assert len(got) == 9
    for rid in ("again", None):
        assert sorted((r.url_key, r.original_id or "", r.outcome, r.headers.get("x", "")) for r in got
                      if r.record_id == rid) == [
            ("a.org", "full", "resolved", "a"), ("b.org", "full", "resolved", "b"), ("c.org", "", "resolved", "c"),
            *[("d.org", "", "no_original", "")] * (1 if rid else 2)]


def test_revisits_of_pages_with_repeated_and_null_ids(spark):
    rows = [(7, f"http://x{i}.org/", f"page {i}") for i in range(20)]
    rows += [(None, f"http://y{i}.org/", f"page {i}") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = revisits.resolve(revisits.crawl_records(pages)).collect()
    assert sorted((r.url_key, r.record_id, r.original_id, r.outcome) for r in got) == sorted(
        (url.removeprefix("http://").rstrip("/"), rid and f"revisit-{rid}", rid and f"response-{rid}", "resolved")
        for rid, url, _ in rows)
