"""Packing, token counts, exact dedup, language ID, sharding."""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sigloom.llm import bpe, language_id, packing, queries, sharding, token_counts
from sigloom.llm.exact_dedup import exact_classes, exact_dedup


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


# --- packing


@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
@settings(max_examples=150, deadline=None)
def test_least_slack_is_the_best_fill_with_the_longest_piece(lengths):
    counts = [lengths.count(n) for n in range(21)]
    used = packing.least_slack(counts, 20)
    assert all(k <= counts[n] for n, k in used.items())
    rest = sorted(lengths)[:-1]
    best = max(s for r in range(len(rest) + 1) for c in itertools.combinations(rest, r) if (s := max(lengths) + sum(c)) <= 20)
    assert sum(n * k for n, k in used.items()) == best


def test_pack_lengths_uses_each_piece_once():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1024, 3000).tolist()
    windows = list(packing.pack_lengths(lengths, 1024))
    assert sorted(itertools.chain(*windows)) == list(range(3000))
    assert all(sum(lengths[i] for i in w) <= 1024 for w in windows)
    assert sum(lengths) / (1024 * len(windows)) > 0.99


def check_pieces(rows, texts, library, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in texts.items():
        ids, at = [*library_ids(library, text), 0], 0
        for r in sorted(by_doc.pop(i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert not by_doc
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return sum(r.length for r in rows) / (capacity * len(by_sequence))


def test_packing_round_trip(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.op1_packing(spark, sf_dir).collect()
    assert check_pieces(rows, {r.doc_id: r.text for r in docs.collect()}, library, 1024) > 0.97


def test_packing_edges(spark, edges, nothing, library):
    once = edges.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_pieces(packing.pack_documents(once, capacity=64).collect(), {r.doc_id: r.text for r in once.collect()}, library, 64)
    assert packing.pack_documents(edges).where("doc_id is null").count() == 2
    assert packing.pack_documents(edges).where("doc_id = 7").count() == 2
    assert packing.pack_documents(nothing).count() == 0
    small = packing.pack_documents(once, capacity=64, most_pieces=2).collect()
    check_pieces(small, {r.doc_id: r.text for r in once.collect()}, library, 64)


# --- token counts


@given(st.text(alphabet=st.sampled_from("ab Z\n\t'’sé9.,_　\x1c\x85 "), max_size=60))
@settings(max_examples=150, deadline=None)
def test_ids_are_the_librarys(text):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = bpe.encoder()
    assert enc._tik and enc.ids(text) == library_ids(library, text)
    assert sum(enc.counts(token_counts.safe_parts(text, 5))) == len(enc.ids(text))


def test_token_counts(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op10_token_counts(spark, sf_dir).collect():
        n = len(library_ids(library, texts.pop(r.doc_id)))
        assert (r.n_tokens, r.over_limit) == (n, n > 1024)
    assert not texts


def test_token_counts_edges(edges, nothing, library):
    rows = token_counts.token_counts(edges, part_chars=500, batch_bytes=2000).collect()
    assert len(rows) == edges.count()
    want = Counter((r.doc_id, len((r.text or "").encode()), len(library_ids(library, r.text))) for r in edges.collect())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want
    assert token_counts.token_counts(nothing).count() == 0


RUNS = [" " * 1_500_000, "\n" * 1_200_000 + "end", "a " + "\t" * 1_000_000 + " b <|endoftext|>", "z" * 300_000, "-" * 300_000, ("word  \n" * 20_000) + " " * 60_000 + "x"]


def test_very_long_runs_of_one_sign(spark, library):
    docs = spark.createDataFrame(list(enumerate(RUNS)), "doc_id long, text string")
    want = {i: len(library_ids(library, t)) for i, t in enumerate(RUNS)}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs).collect()} == want
    check_pieces(packing.pack_documents(docs).collect(), dict(enumerate(RUNS)), library, 1024)


def test_other_vocabularies(edges):
    import sentencepiece

    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    piece = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for name, count in (("word_bpe_49k.json", lambda t: len(word.encode(t, add_special_tokens=False).ids)), ("piece_bpe_32k.model", lambda t: len(piece.encode(t)))):
        rows = token_counts.token_counts(edges, path=public_tokenizers.path(name)).collect()
        assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((r.doc_id, count(r.text or "")) for r in edges.collect())


# --- exact dedup


def brute_classes(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out.update((i, keep, len(ids), i == keep or keep is None, hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    return out


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_exact_classes(spark, edges, nothing, salts):
    rows = [(r.doc_id, r.text) for r in edges.collect()] + [(100 + i, f"text {i % 5}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, exact_classes(df, salts=salts).collect())) == brute_classes(rows)
    assert exact_classes(nothing, salts=salts).count() == 0


def test_exact_classes_fail_rather_than_merge(spark):
    from sigloom.llm import exact_dedup as module

    df = spark.createDataFrame([(1, "a"), (65, "b")], "doc_id long, text string")
    real, module.F.sha2 = module.F.sha2, lambda c, n: module.F.lit("same")
    try:
        with pytest.raises(Exception, match="two texts"):
            exact_classes(df, salts=1).collect()
    finally:
        module.F.sha2 = real


def test_exact_dedup_keeps_whole_rows(edges, nothing):
    rows = exact_dedup(edges).collect()
    assert rows[0].asDict().keys() == set(edges.columns)
    assert sorted((r.doc_id, r.text) for r in rows if r.text) == sorted((r.doc_id, r.text) for r in edges.where("doc_id not in (4) and length(text) > 0").dropDuplicates(["doc_id"]).collect())
    assert [(r.doc_id, r.text) for r in rows if not r.text] == [(2, "")]
    assert exact_dedup(nothing).count() == 0


# --- language ID


def test_language_accuracy_on_held_out(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{big}/documents.parquet").collect()}
    rows = queries.op8_language_id(spark, big).collect()
    assert len(rows) == len(known) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id] for r in held) / len(held) > 0.95
    sure = [r for r in held if not r.rejected]
    assert sum(r.lang_pred == known[r.doc_id] for r in sure) / len(sure) > 0.98


def test_language_edges(edges, nothing, spark):
    model = language_id.fit_languages(edges)
    assert set(model.content) == {"en", "de", "fr"} and all(len(c) <= 32_000 for c in model.content.values())
    rows = language_id.predict_languages(edges, model).collect()
    assert len(rows) == edges.count()
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert language_id.predict_languages(nothing, model).count() == 0
    empty = language_id.fit_languages(nothing)
    assert {r.lang_pred for r in language_id.predict_languages(edges, empty).collect()} == {"und"}
    kept = language_id.keep_recognised(edges, model)
    assert kept.columns == edges.columns and kept.where("doc_id in (1, 2, 3)").count() == 0
    same = language_id.predict_languages(edges, model).where("not rejected").count()
    assert kept.count() == same


def test_language_against_plain_compression(spark, edges, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.fit_languages(docs)
    assert all(24_000 <= len(c) <= 32_000 for c in model.content.values())

    def size(text, lang):
        total, raw = 0, text.encode()
        for start in range(0, len(raw), 4096):
            words = zstandard.ZstdCompressionDict(model.content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=6)
            total += len(zstandard.ZstdCompressor(dict_data=words, level=6, write_checksum=False, write_content_size=False, write_dict_id=False).compress(raw[start : start + 4096]))
        return total

    texts = {r.doc_id: r.text for r in docs.limit(60).collect()}
    got = {r.doc_id: r for r in language_id.predict_languages(docs, model).collect()}
    for i, text in texts.items():
        if text and any(c.isalpha() for c in text):
            first, second = sorted((size(text, lang), lang) for lang in model.content)[:2]
            assert got[i].lang_pred == first[1] and got[i].score == (second[0] - first[0]) / second[0] and got[i].rejected == (got[i].score < 0.01)
        else:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)


def test_language_sample_is_bounded_and_spread(spark):
    rows = [(7, "a" + "x" * 500 + "END", "en")] * 300 + [(8, "short", "de"), (9, "ab " * 20_000 + "tail", "fr"), (10, "1234", "fr"), (None, "null id", "fr")]
    model = language_id.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.content["en"] == rows[0][1].encode() and model.content["de"] == b"short"
    assert 24_000 <= len(model.content["fr"]) <= 32_000
    for sizes in ([5, 5, 100], [40, 41, 42], [1], [0, 0, 200], [200] * 70):
        out = language_id.filled([b"z" * n for n in sizes], 60)
        assert len(b"\n".join(out)) <= max(60, 1) and (sum(sizes) + len(sizes) - 1 > 60 or [len(x) for x in out] == sizes)
    with pytest.raises(ValueError, match="languages"):
        language_id.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_languages=2)


# --- sharding


def plain_kd(points, dims, shards, whole=None):
    """Shards of points (weight, *keys), split one by one."""
    if shards == 1 or not points:
        return {tuple(p): 0 for p in points}
    spans = lambda ps: [max(p[d] for p in ps) - min(p[d] for p in ps) for d in dims]
    whole = whole or [max(1, x) for x in spans(points)]
    parts = [x / w for x, w in zip(spans(points), whole)]
    d = dims[parts.index(max(parts))]
    goal = sum(p[0] for p in points) * (shards // 2) / shards
    cuts = sorted({p[d] for p in points} | {max(p[d] for p in points) + 1})
    below = lambda c: sum(p[0] for p in points if p[d] < c)
    cut = min(cuts, key=lambda c: abs(below(c) - goal))
    low, high = [p for p in points if p[d] < cut], [p for p in points if p[d] >= cut]
    half = shards // 2
    return plain_kd(low, dims, half, whole) | {p: k + half for p, k in plain_kd(high, dims, shards - half, whole).items()}


@pytest.mark.parametrize("shards", [2, 5, 24])
def test_kd_tree_is_the_plain_split(spark, shards):
    rng = np.random.default_rng(shards)
    rows = list({tuple(map(int, r)): None for r in np.column_stack([rng.integers(1, 100_000, 700), rng.integers(0, 5000, 700), rng.integers(0, 300, 700) ** 2 // 30])})
    df = spark.createDataFrame(rows, "size long, x long, y long")
    placed = df.withColumn("shard", sharding.kd_tree(df, ["x", "y"], shards).place())
    assert {(r.size, r.x, r.y): r.shard for r in placed.collect()} == plain_kd(rows, [1, 2], shards)



def check_shards(rows, texts, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in by.values())
    return [sum(r.size for r in by.get(k, [])) for k in range(shards)]


def test_shards_are_near_equal(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{big}/documents.parquet").collect()}
    rows = queries.op7_sharding(spark, big).collect()
    sizes = check_shards(rows, texts, 24)
    most = max(r.size for r in rows)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert max(sizes) - min(sizes) <= 4 * most
    place = {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        assert place.setdefault(raw, r.shard) == r.shard


def test_shard_edges(edges, nothing):
    rows = sharding.kd_shards(edges, shards=5, rows_a_task=2).collect()
    assert len(rows) == edges.count()
    check_shards(rows, None, 5)
    assert sharding.kd_shards(nothing).count() == 0


def test_shards_of_target_bytes(spark, sf_dir, nothing):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sharding.kd_shards(docs, target_bytes=4000).collect()
    total, most = sum(r.size for r in rows), max(r.size for r in rows)
    shards = -(-total // 4000)
    sizes = check_shards(rows, None, shards)
    assert shards > 24 and max(sizes) <= 4000 + 4 * most
    assert sharding.kd_shards(nothing, target_bytes=4000).count() == 0
