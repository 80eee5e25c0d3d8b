"""Spelling variants, periodic runs and token files against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sigloom.llm import bpe, periodic_runs, queries, spelling, token_files

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def texts_of(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


# --- spelling variants


def plain_counts(rows, least=6, noise=True):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(low)
            if noise and i is not None and (h := zlib.crc32(f"{i}:{w}".encode())) % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += len(w) >= least
    return counts


def within_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_variants(counts, least_n=5, times=5):
    words = {w: n for w, n in counts.items() if n >= least_n}
    holes = defaultdict(set)
    for w in words:
        for form in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            holes[form].add(w)
    near = defaultdict(set)
    for own in holes.values():
        for a, b in itertools.combinations(sorted(own), 2):
            if within_one(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def test_spelling_variants(spark, sf_dir):
    want = plain_variants(plain_counts(texts_of(spark, sf_dir).items()))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in queries.op11_spelling_variants(spark, sf_dir).collect()}
    assert got == want and any(v[0] for v in want.values())


def test_chains_ties_and_letters(spark):
    rng = random.Random(5)
    counts = {"abcdefgh": 1000, "abcdefg": 200, "abcdef": 40, "abcdex": 40, "abcdeé": 5, "zzzzzz": 5, "zzzzzzz": 30, "ÀÉÉÉÉÉ": 7, "ÀÉÉÉÉ÷": 70, "ababababab": 6, "abababab×b": 31, "bababababa": 200}
    for _ in range(600):
        counts["".join(rng.choice("abé") for _ in range(rng.randint(6, 9)))] = rng.choice([4, 5, 25, 26, 125, 700])
    text = " ".join(w for w, n in counts.items() for _ in range(n))
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (None, "abcdefgh 123"), (None, "abcdefgh 123")], "doc_id long, text string")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(docs).collect()}
    want = plain_variants(plain_counts([(1, text), (None, "abcdefgh abcdefgh")], noise=False))
    assert got == want
    # Chains are followed to their end; of near words of equal count the first in code-point order wins.
    chain = ["abcdef" + "ghijkl"[:k] for k in range(6)]
    docs = spark.createDataFrame([(k, " ".join([w] * (5 * 5**k))) for k, w in enumerate(chain)] + [(9, "mnopqr " * 5 + "mnopqs " * 25 + "mnopqt " * 25)], "doc_id long, text string")
    got = {r.word: (r.form, r.root) for r in spelling.spelling_variants(docs).collect()}
    assert [got[w] for w in chain] == [*[(chain[k + 1], chain[5]) for k in range(5)], (None, chain[5])]
    assert got["mnopqr"] == ("mnopqs", "mnopqs")


@given(st.lists(st.integers(1, 9), min_size=2, max_size=8))
@settings(max_examples=100, deadline=None)
def test_pivots_are_the_lightest_disjoint_pair(weights):
    places = [p + p // 3 for p in range(len(weights))]
    pairs = [(weights[i] + weights[j], (a, b)) for (i, a), (j, b) in itertools.combinations(enumerate(places), 2) if b - a >= 2]
    assert spelling.pivots(places, weights, 2) == list(min(pairs)[1] if pairs else ())


def test_spelling_edges(edges, nothing):
    rows = {r.word: r.n for r in spelling.spelling_variants(edges).collect()}
    assert rows == {w: n for w, n in plain_counts([(None, r.text) for r in edges.collect()]).items() if n >= 5}
    assert spelling.spelling_variants(nothing).count() == 0
    few = spelling.word_counts(edges, most_words=1)
    assert {r.word: r.n for r in few.collect()} == {w: n for w, n in plain_counts([(None, r.text) for r in edges.collect()]).items() if n}


# --- periodic runs


def plain_runs(w, least, times):
    out = set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and (n := j - i + q) >= max(least, times * q):
                s = w[i : i + n]
                if next(p for p in range(1, q + 1) if s[p:] == s[:-p]) == q:
                    out.add((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(i, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(i).encode()), len(w)
    if h % 10 == 0 and n and i is not None:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = plain_runs(w, 24, 3)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_periodic_runs(spark, sf_dir):
    texts = texts_of(spark, sf_dir)
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    assert got.keys() == texts.keys() and any(v[0] for v in got.values())
    short = [i for i, t in texts.items() if len(t or "") < 20_000]
    assert len(short) > 100
    for i in short:
        assert got[i] == plain_row(i, texts[i])


@given(st.integers(0, 10**6))
@settings(max_examples=300, deadline=None)
def test_runs_are_all_maximal_repetitions(seed):
    rng = random.Random(seed)
    w = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 80))]
    for _ in range(rng.randint(0, 3)):
        if w:
            a, p = rng.randrange(len(w)), rng.randint(1, 9)
            for i in range(a + p, min(len(w), a + rng.randint(1, 60))):
                w[i] = w[i - p]
    for least, times in ((24, 3), (6, 2), (10, 3), (9, 4)):
        assert periodic_runs.runs_of(w, least, times) == plain_runs(w, least, times)


def test_long_periodic_texts_take_no_square_time():
    assert periodic_runs.runs_of([b"ha"] * 100_000) == [(0, 100_000, 1)]
    assert periodic_runs.runs_of([b"%d" % (i % 6600) for i in range(60_000)]) == [(0, 60_000, 6600)]
    shared = [b"%d" % i for i in range(30)]  # a passage that ten thousand different words divide
    assert periodic_runs.runs_of(list(itertools.chain(*[[*shared, b"u%d" % j] for j in range(10_000)]))) == []
    a, b = [b"a"], [b"b"]
    while len(b) < 40_000:
        a, b = b, b + a
    assert len(periodic_runs.runs_of(b)) > 1000


def test_places_in_chunks():
    rng = random.Random(3)
    own = rng.sample(range(100_000), 5000)
    places = periodic_runs.Places(own[0])
    for x in own[1:]:
        places.add(x)
    line = sorted(own)
    assert list(places) == line and places.n == 5000 and len(places.chunks) > 4
    for k in range(1, 4999, 7):
        assert places.around(line[k]) == (line[k - 1], line[k + 1])
    assert places.around(line[0])[0] == places.around(line[-1])[1] == -1


def test_periodic_edges(spark, edges, nothing):
    rows = periodic_runs.find_periodic_runs(edges).collect()
    assert len(rows) == edges.count()
    assert Counter((r.doc_id, r.n_words) for r in rows) == Counter((r.doc_id, len((r.text or "").encode().split())) for r in edges.collect())
    assert periodic_runs.find_periodic_runs(nothing).count() == 0
    said = "lead " + "one two three " * 20 + "end\x1cone"
    r = periodic_runs.find_periodic_runs(spark.createDataFrame([(1, said)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r.runs] == [(1, 60, 3)] and r.collapsed == "lead one two three end\x1cone"


# --- token files


@pytest.mark.parametrize("width", [1, 3, 7, 8, 13, 16, 17, 25, 32])
def test_bits_round_trip(width):
    for n in (0, 1, 7, 8, 9, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << width, n).astype(np.uint32)
        raw = token_files.pack(ids, width)
        assert len(raw) == -(-n * width // 8) and (token_files.unpack(raw, n, width) == ids).all()
        bits = "".join(format(int(x), f"0{width}b")[::-1] for x in ids)
        assert raw == bytes(int(bits[k : k + 8][::-1], 2) for k in range(0, len(bits), 8))


@given(st.lists(st.sampled_from(["a", "Bc", "É", "é", "é", "́", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "　", "'s", "'", "ß", "İ", "Σ", "9", ",", "!?", "<|endoftext|>", "<|start", "\U0001f600", "한", "한"]), max_size=30).map("".join))
@settings(max_examples=300, deadline=None)
def test_word_ids_are_the_librarys(text):
    enc = bpe.word_encoder(WORD_BPE)
    assert enc.words is not None
    want = enc.plain._tok.encode(text, add_special_tokens=False).ids
    for before in ([], ["", "a  b"]):
        ids, ends = enc.ids(pa.array([*before, text, "", "c"])[len(before) :] if before else pa.array([text, "", "c"]))
        assert ids[: ends[0]].tolist() == want and ends[0] == ends[1] == len(want) and len(ids) == ends[2] == len(want) + 1


def test_word_memory_is_bounded():
    enc, tok = bpe.WordEncoder(WORD_BPE, most_bytes=3000), Tokenizer.from_file(WORD_BPE)
    for k in range(60):
        text = " ".join(f"word{chr(97 + k % 26)}{chr(97 + j)} the" for j in range(8)) + " " + "x" * 500
        assert enc.ids(pa.array([text]))[0].tolist() == tok.encode(text, add_special_tokens=False).ids
        assert len(enc.words) < 40 and "x" * 500 not in enc.words
    other = bpe.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert other.words is None and other.most_id == 50256
    ids, ends = other.ids(pa.array(["two words", "", "three"]))
    assert ids.tolist() == other.plain.ids("two words") + other.plain.ids("three") and ends.tolist() == [2, 2, 3]


def test_ended():
    out, ends = token_files.ended(np.array([5, 6, 7], np.uint32), np.array([2, 2, 3]), 9)
    assert out.tolist() == [5, 6, 9, 9, 7, 9] and ends.tolist() == [3, 4, 6]


def plain_files(rows, end_id=2):
    tok, at, out = Tokenizer.from_file(WORD_BPE), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files(spark, sf_dir):
    got = sorted(map(tuple, queries.op13_token_files(spark, sf_dir).collect()))
    assert got == plain_files(texts_of(spark, sf_dir).items())


@pytest.mark.parametrize("block_ids", [1 << 15, 64, 13])
def test_token_file_edges(spark, edges, nothing, tmp_path, block_ids):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    token_files.write_token_files(edges, str(tmp_path / "d"), WORD_BPE, block_ids=block_ids, shard_bytes=50_000)
    want = plain_files(rows)
    for most in (1 << 20, 100):
        back = [tuple(r) for r in token_files.read_token_files(spark, str(tmp_path / "d"), most_ids=most).collect()]
        assert Counter(back) == Counter(want)
    files = token_files.manifest(spark, str(tmp_path / "d")).orderBy("shard").collect()
    assert len(files) > 1 and sum(f.n_docs for f in files) == len(rows) and [f.start for f in files] == [sum(g.n_ids for g in files[:k]) for k in range(len(files))]
    for f in files:
        with token_files.IdReader(str(tmp_path / "d" / "ids" / f.file)) as file:
            whole = file.ids(0, file.n_ids)
            assert file.width == 16 and len(whole) == f.n_ids
            for a, b in ((0, 1), (5, 5), (f.n_ids // 3, f.n_ids // 2), (f.n_ids - 1, f.n_ids + 9)):
                assert (file.ids(a, b) == whole[a:b]).all()
    token_files.write_token_files(nothing, str(tmp_path / "none"), WORD_BPE)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0
    token_files.drop_token_files(spark, str(tmp_path / "d"))
    assert not (tmp_path / "d").exists()


def test_other_files_are_refused(tmp_path):
    (tmp_path / "x").write_bytes(b"0" * 100)
    with pytest.raises(ValueError, match="no packed ids"):
        token_files.IdReader(str(tmp_path / "x"))
