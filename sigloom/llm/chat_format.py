"""Chat formatting with column functions only: typed parts in, one string per conversation out, and back.

A turn is written ``<|turn|>role\\ncontent<|end|>\\n``. Inside texts and roles a backslash is put
into every control string, ours and the ``[INST]`` and ``</s>`` of another common template, so
that a marker in the output is always a real one; reading takes the backslash out again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import let, running

# The template.
TURN, END = "<|turn|>", "<|end|>"
_CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
_FIELDS = [f.split(":") for f in PARTS[13:-2].split(",")]

# Attachments by the suffix of a link's target, and what counts as one token of a text.
SUFFIXES = {"image": "png|jpe?g|gif|webp", "audio": "mp3|wav|flac|ogg", "document": "pdf|docx?|odt"}
MEDIA = r"!?\[[^\]\n]*\]\([^()\s]+\.(?:" + "|".join(SUFFIXES.values()) + r")\)"
WORD = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\x09-\x0D\x20]"
_PLACEHOLDER = r"<\|(?:image|audio|document)\|>"


def _part(**given: Column) -> Column:
    return F.struct(*[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in _FIELDS])


def linked_parts(text: Column) -> Column:
    """A text as typed parts: links to media files become attachments that keep the link as their reference."""
    links = F.regexp_extract_all(text, F.lit(MEDIA), 0)
    kind = lambda link: F.when(link.rlike(rf"\.(?:{SUFFIXES['image']})\)$"), "image").when(link.rlike(rf"\.(?:{SUFFIXES['audio']})\)$"), "audio").otherwise("document")
    linked = lambda ls: F.transform(F.split(text, MEDIA, -1), lambda gap, i: F.array(_part(type=F.lit("text"), text=gap), F.when(i < F.size(ls), _part(type=kind(F.get(ls, i)), ref=F.get(ls, i)))))
    return F.filter(F.flatten(let(links, linked)), lambda p: p.isNotNull())


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    halves = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(halves, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def visited(part: Column, patch: int = 28, audio_rate: float = 25.0, page_tokens: int = 512) -> Column:
    """What one part becomes: its content, its tokens, and its reference if it is an attachment.

    Text becomes its escaped self and counts its words and signs; image, audio and document parts become
    ``<|type|>`` and count as many tokens as a model would expand them to: patches, frames, pages.
    A type that is null or unknown counts as text.
    """
    kind = part["type"]
    attached = F.coalesce(kind.isin("image", "audio", "document"), F.lit(False))
    text = F.coalesce(part["text"], F.lit(""))
    tokens = (
        F.when(kind == "image", F.ceil(F.coalesce(part["width"], F.lit(0)) / patch) * F.ceil(F.coalesce(part["height"], F.lit(0)) / patch))
        .when(kind == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * audio_rate))
        .when(kind == "document", F.coalesce(part["pages"], F.lit(0)).cast("long") * page_tokens)
        .otherwise(F.regexp_count(text, F.lit(WORD)))
        .cast("long")
    )
    content = F.when(attached, F.concat(F.lit("<|"), kind, F.lit("|>"))).otherwise(escape(text))
    return F.struct(content.alias("content"), tokens.alias("tokens"), F.when(attached, F.struct(kind.alias("type"), part["ref"].alias("ref"), tokens.alias("tokens"))).alias("attachment"))


def format_conversations(turns: DataFrame, loss_role: str = "assistant", parts_col: str | None = None) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans, attachments, n_tokens``.

    ``turns`` has ``conv_id, turn, role`` and either ``text`` or an array of typed parts
    (:data:`PARTS`). Turns are ordered by turn, role and content, nulls first; a null role is
    empty, a null text or part list is an empty content, and a null ``conv_id`` is one
    conversation of its own. ``loss_spans`` are ``start, length`` of the content of
    ``loss_role`` in code points of ``formatted``, and ``first``, the number of attachments before
    it; ``attachments`` follow the order of the placeholders. Repeated rows are repeated turns; other columns are not read.
    """
    parts = F.col(f"`{parts_col}`") if parts_col else F.array(_part(type=F.lit("text"), text=F.col("text")))
    seen = F.transform(F.coalesce(parts.cast(PARTS), F.array().cast(PARTS)), lambda p: visited(p))
    flat = turns.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), seen.alias("seen"))
    flat = flat.select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            F.array_join(F.transform("seen", lambda x: x["content"]), "").alias("content"),
            F.aggregate("seen", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("tokens"),
            F.filter(F.transform("seen", lambda x: x["attachment"]), lambda x: x.isNotNull()).alias("attachments"),
        ).alias("t"),
    )
    whole = flat.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = lambda t: F.concat(F.lit(TURN), _escape_role(t["role"]), F.lit("\n"))
    written = F.transform("turns", lambda t: F.struct(head(t).alias("head"), t["content"].alias("content"), (t["role"] == loss_role).alias("loss"), F.size(t["attachments"]).alias("n")))
    tail = END + "\n"
    whole = whole.withColumn("written", written)
    chars = running(F.transform("written", lambda w: F.length(w["head"]) + F.length(w["content"]) + len(tail)))
    before = running(F.transform("written", lambda w: w["n"]))
    span = lambda at, k, w, i: F.struct((F.get(at, i) + F.length(w["head"])).alias("start"), F.length(w["content"]).alias("length"), F.get(k, i).alias("first"), w["loss"].alias("loss"))
    spans = let(chars, lambda at: let(before, lambda k: F.transform("written", lambda w, i: span(at, k, w, i))))
    spans = F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"), s["first"].alias("first")))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("written", lambda w: F.concat(w["head"], w["content"], F.lit(tail))), "").alias("formatted"),
        spans.alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
    )


def restored(formatted: Column, attachments: Column, first: Column | int = 0) -> Column:
    """``formatted`` with each placeholder replaced by its attachment's reference, escaped like a text."""
    pieces = F.split(formatted, _PLACEHOLDER, -1)
    back = lambda p: F.transform(p, lambda x, i: F.concat(x, F.when(i < F.size(p) - 1, escape(F.coalesce(F.get(attachments, i + first)["ref"], F.lit("")))).otherwise("")))
    return F.array_join(let(pieces, back), "")


def read_turns(formatted: Column, attachments: Column) -> Column:
    """The turns of a formatted conversation, unescaped: an array of ``(role, text)``, references as in :func:`restored`."""
    pieces = F.filter(F.split(restored(formatted, attachments), r"<\|turn\|>"), lambda p: p != "")
    cut = lambda p: F.instr(p, "\n")
    tail = len(END) + 1
    return F.transform(
        pieces,
        lambda p: F.struct(
            _unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substr(p, cut(p) + 1, F.length(p) - cut(p) - tail)).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column, attachments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, references in the place of their placeholders."""
    return F.array_join(F.transform(spans, lambda s: unescape(restored(F.substr(formatted, s["start"] + 1, s["length"]), attachments, s["first"]))), "")
