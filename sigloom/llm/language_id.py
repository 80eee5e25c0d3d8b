"""Language ID by compression: the language whose dictionary makes a text smallest."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import released, settled, ship
from .batches import by_bytes, filter_rows

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class LanguageModel:
    """A raw-content dictionary for each language. Its size is bounded by ``dictionary_bytes`` a language."""

    content: dict[str, bytes]

    def compressors(self, level: int) -> dict[str, zstandard.ZstdCompressor]:
        out = {}
        for lang, content in sorted(self.content.items()):
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            out[lang] = zstandard.ZstdCompressor(dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False, level=level)
        return out


def spread(text: Column, key: Column, most: Column, piece: int = 125) -> Column:
    """About ``most`` characters of ``text`` from all over it, or all of it where it is no longer.

    Pieces of ``piece`` characters lie at even distances; ``key`` moves them all along.
    """
    n = F.char_length(text)
    pieces = F.greatest(F.lit(1), F.ceil(most / piece)).cast("int")
    step = n / pieces
    start = lambda k: F.floor(step * k + F.pmod(key, F.lit(1000)) / 1000 * F.greatest(step - piece, F.lit(0.0))).cast("int") + 1
    cut = F.array_join(F.transform(F.sequence(F.lit(0), pieces - 1), lambda k: F.substring(text, start(k), F.lit(piece))), " ")
    return F.when(n <= most, text).otherwise(cut)


def fit_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", learn: Column | None = None, texts_a_language: int = 256, dictionary_bytes: int = 32_000, most_languages: int = 4096
) -> LanguageModel:
    """Dictionaries from a bounded sample of labelled rows.

    The sample is the ``texts_a_language`` rows of each non-null language with the smallest hash
    of their id, among those that ``learn`` lets through. Each gives an equal share of
    ``dictionary_bytes``, in pieces from all over its text; where short texts leave room, the
    longer ones fill it. Rows are ranked on ids and languages alone (each task passes on its own
    first rows), then only their pieces are fetched. Null, empty and letterless texts teach
    nothing. Without labelled rows the model is empty. The model sits on the driver and in each
    task, so more than ``most_languages`` labels are an error.
    """
    rows = docs.where(F.col(lang_col).isNotNull())
    if learn is not None:
        rows = rows.where(learn)
    key = F.xxhash64(F.col(id_col))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), key.alias("key"), F.col(text_col).alias("text"))
    ranked = rows.select("lang", "id", "key").withColumn("salt", F.pmod("key", F.lit(64)))
    for group in (["lang", "salt"], ["lang"]):  # so that a language of any size reaches a task as 64 short lists
        rank = F.row_number().over(Window.partitionBy(*group).orderBy("key", "id"))
        ranked = ranked.withColumn("rank", rank).where(F.col("rank") <= texts_a_language).drop("rank")
    picked = settled(ranked.select("lang", "id").distinct(), "picked")
    sizes = picked.groupBy("lang").agg(F.count("*").alias("n"))
    known = sizes.limit(most_languages + 1).collect()
    if len(known) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    # Four shares of each text, so that long ones can fill what short ones leave.
    few = picked.join(sizes, "lang").select("lang", "id", (4 * dictionary_bytes / F.col("n")).alias("share"))
    if sum(r["n"] for r in known) <= 1 << 16:  # beyond that, a join like any other
        few = F.broadcast(few)
    pieces = rows.where(F.col("text").rlike(r"\p{L}")).join(few, ["lang", "id"]).select("lang", "id", spread(F.col("text"), F.col("key"), F.col("share")).alias("text"))
    found: dict[str, list[tuple]] = {}
    for r in pieces.groupBy("lang", "id").agg(F.min("text").alias("text")).collect():  # one row for an id that is repeated
        found.setdefault(r["lang"], []).append((str(r["id"]), r["text"]))
    released(picked)
    return LanguageModel({lang: b"\n".join(filled([t.encode() for _, t in sorted(own)], dictionary_bytes)) for lang, own in found.items()})


def filled(texts: list[bytes], most: int) -> list[bytes]:
    """The texts cut to one length so that with a byte between them they come to ``most`` bytes, or whole if they are less."""
    texts = texts[: (most + 1) // 2]  # so that each gets a byte at least
    room, left = most - len(texts) + 1, len(texts)
    for n in sorted(map(len, texts)):
        if n * left > room:
            return [t[: room // left] for t in texts]
        room, left = room - n, left - 1
    return texts


def predict_languages(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", margin: float = 0.01, level: int = 6, chunk_bytes: int = 4096
) -> DataFrame:
    """One row per input row: id, ``lang_pred, score, rejected``.

    The whole text is compressed in chunks of ``chunk_bytes`` with each language's dictionary;
    the smallest sum wins, ties going to the first language by name. ``score`` is the winner's
    lead over the second: 0 if they are level, 1 if there is no second. ``rejected`` marks leads
    under ``margin`` and texts that are null or hold no letter; those are ``und`` with score 0.
    So is every text under an empty model. Ids may be null or repeat; other columns are not read.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(model, margin, level, chunk_bytes)
        for batch in by_bytes(batches, 1):
            langs, scores, rejected = zip(*map(judge, batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(predict, f"id {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)


def keep_recognised(docs: DataFrame, model: LanguageModel, text_col: str = "text", margin: float = 0.01, level: int = 6, chunk_bytes: int = 4096) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`predict_languages` does not reject."""
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(model, margin, level, chunk_bytes)
        for batch in by_bytes(batches, place):
            yield batch.filter(pa.array([not judge(t)[2] for t in batch.column(place).to_pylist()], pa.bool_()))

    return filter_rows(docs, keep)


def _judge(model: LanguageModel, margin: float, level: int, chunk_bytes: int) -> Callable[[str | None], tuple[str, float, bool]]:
    """Language, score and rejection of one text."""
    coders = model.compressors(level)

    def judge(text: str | None) -> tuple[str, float, bool]:
        if not coders or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        raw = text.encode()
        sizes = dict.fromkeys(coders, 0)
        for start in range(0, len(raw), chunk_bytes):
            chunk = raw[start : start + chunk_bytes]
            for lang, coder in coders.items():
                sizes[lang] += len(coder.compress(chunk))
        best, *rest = sorted(sizes.items(), key=lambda x: x[1])
        score = (rest[0][1] - best[1]) / rest[0][1] if rest else 1.0
        return best[0], score, score < margin

    return judge
