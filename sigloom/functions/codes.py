"""Clip codes: structured file names decoded by column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a stem in order, and the channels.
PARTS = ["modality", "vocal_channel", "emotion", "intensity", "statement", "repetition", "actor"]
CHANNELS = {"01": "speech", "02": "song"}
ACTORS = (1, 24)
NO_SONG_ACTOR = 18


def stem_of(path: Column) -> Column:
    """The file name without folders and last suffix."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _actor(pieces: Column) -> Column:
    last = F.get(pieces, F.lit(6))
    return F.when(last.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(last).try_cast("int"))


def reject_reason(stem: Column) -> Column:
    """Why a stem is no clip code, or null: seven parts, of which the last is an integer."""
    return _let(
        F.split(stem, "-", -1),
        lambda p: F.when(p.isNull(), "no name")
        .when(F.size(p) != 7, F.concat(F.lit("expected 7 parts, found "), F.size(p).cast("string")))
        .when(_actor(p).isNull(), "actor is not an integer"),
    )


def clip_code(stem: Column) -> Column:
    """The seven fields as a struct, null for a rejected stem; all but the actor stay text, unchecked."""

    def code(p: Column) -> Column:
        fields = [F.get(p, F.lit(i)).alias(name) for i, name in enumerate(PARTS[:6])]
        return F.when((F.size(p) == 7) & _actor(p).isNotNull(), F.struct(*fields, _actor(p).alias("actor")))

    return _let(F.split(stem, "-", -1), code)


def channel_label(channel: Column) -> Column:
    """``speech`` or ``song``; null for another channel."""
    out = F.lit(None).cast("string")
    for code, label in CHANNELS.items():
        out = F.when(channel == code, label).otherwise(out)
    return out


def actor_folder(actor: Column) -> Column:
    """``Actor_01``; numbers over 99 keep all their digits."""
    return F.format_string("Actor_%02d", actor)


def output_path(stage: str, channel: Column, folder: Column, stem: Column, ext: str) -> Column:
    return F.concat_ws("/", F.lit(stage), channel, folder, F.concat(stem, F.lit(f".{ext}")))


def eligible(code: Column) -> Column:
    """Full audio-video speech or song, without the one actor who has no song."""

    def fits(c: Column) -> Column:
        song = c["vocal_channel"] == "02"
        return (c["modality"] == "01") & c["vocal_channel"].isin(*CHANNELS) & ~((c["actor"] == NO_SONG_ACTOR) & song)

    return F.coalesce(_let(code, fits), F.lit(False))


def in_actor_range(actor: Column, low: int = ACTORS[0], high: int = ACTORS[1]) -> Column:
    return actor.between(low, high)


def member_name(path: Column, sources: list[str]) -> Column:
    """A file's name inside its archive: relative to the source that holds it, or null outside of all.

    With several sources the folder above the source comes first, so names cannot clash.
    """
    out = F.lit(None).cast("string")
    for source in reversed(sources):
        rest = F.substring(path, len(source) + 2, 1 << 30)
        if len(sources) > 1:
            rest = F.concat_ws("/", F.lit(source.rstrip("/").split("/")[-2]), rest)
        out = F.when(F.startswith(path, F.lit(source + "/")), rest).otherwise(out)
    return out
