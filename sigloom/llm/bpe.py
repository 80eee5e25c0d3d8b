"""Byte-level BPE ids inside tasks: the vocabulary file's own merges, encoded in batches.

``tokenizers`` defines the ids. A byte-level BPE .json is loaded into ``tiktoken``, which gives the
same ids about three times as fast (tests compare them); any other .json stays with ``tokenizers``,
and so does a text with a run of very much white space, on which the other one's pattern overflows.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import sys
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT = public_tokenizers.path("byte_bpe_50k.json")

def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, the other way round."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Characters of white space in a row that are left to ``tokenizers``; well below what overflows.
_BLANKS = 50_000
_WHITE = re.compile(r"\s{2,}")


def blank(text: str) -> bool:
    """Whether a text holds a run of very much white space. Linear in the text."""
    return len(text) > _BLANKS and any(m.end() - m.start() > _BLANKS for m in _WHITE.finditer(text))


class Encoder:
    """ids(), counts() and id_bytes() of one vocabulary file; special strings in a text count as such."""

    def __init__(self, path: str):
        self._path = path
        if path.endswith(".model"):
            import sentencepiece

            self._piece = sentencepiece.SentencePieceProcessor(model_file=path)
            self._tik = self._tok = None
            self.special = []
            return
        self._piece = None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model.get("type") == "BPE"
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and not spec.get("normalizer")
            and not model.get("ignore_merges")
            and all(t.get("special") and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec.get("added_tokens", []))
        )
        self._tik = self._tok = None
        if plain:
            import tiktoken

            back = _byte_letters()
            ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
            ranks = {bytes(back[c] for c in w): i for w, i in model["vocab"].items() if w not in ids}
            self._tik = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ids)
        else:
            self._library()

    def _library(self):
        if self._tok is None:
            from tokenizers import Tokenizer

            self._tok = Tokenizer.from_file(self._path)
            self._tok.no_truncation()
            self._tok.no_padding()
        return self._tok

    def ids(self, text: str) -> list[int]:
        if self._piece:
            return self._piece.encode(text)
        if not self._tik or blank(text):
            return self._library().encode(text, add_special_tokens=False).ids
        if any(s in text for s in self.special):
            return self._tik.encode(text, allowed_special="all")
        return self._tik.encode_ordinary(text)

    def counts(self, texts: list[str]) -> list[int]:
        if self._piece:
            return [len(x) for x in self._piece.encode(texts, num_threads=1)]
        if not self._tik:
            return [len(x) for x in self._library().encode_batch(texts, add_special_tokens=False)]
        marked = [None if blank(t) else any(x in t for x in self.special) for t in texts]
        plain = iter(self._tik.encode_ordinary_batch([t for t, m in zip(texts, marked) if m is False], num_threads=1))
        special = iter(self._tik.encode_batch([t for t, m in zip(texts, marked) if m], num_threads=1, allowed_special="all"))
        return [len(self.ids(t)) if m is None else len(next(special if m else plain)) for t, m in zip(texts, marked)]

    def id_bytes(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        ids = array("I", self.ids(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


@functools.cache
def encoder(path: str = DEFAULT) -> Encoder:
    """One encoder for each vocabulary file and worker process."""
    return Encoder(path)


class _Words(dict):
    """Ids by word, as bytes. A word that is not there is looked up among older ones or encoded, and kept."""

    LONGEST = 64
    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")

    def __init__(self, tok, most_bytes: int):
        super().__init__({"": b""})
        self.tok, self.model = tok, tok.model
        self.letters = {b: c for c, b in _byte_letters().items()}
        self.most, self.room, self.older = most_bytes, most_bytes, {}

    def __missing__(self, word: str) -> bytes:
        raw = self.older.get(word)
        if raw is None:
            m = self.PLAIN.fullmatch(word) if len(word) <= self.LONGEST else None
            raw = b"".join([self._piece(p) for p in m.groups() if p]) if m else array("I", self.tok.encode(word, add_special_tokens=False).ids).tobytes()
        if len(word) <= self.LONGEST:
            self[word] = raw
            self.room -= 250 + len(raw) + 2 * len(word)
        return raw

    def _piece(self, piece: str) -> bytes:
        written = piece.lower()
        if not written.isascii():
            written = written.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(written)]).tobytes()

    def renewed(self) -> _Words:
        """A new generation if this one is full, with this as the older one, so that words in use stay."""
        if self.room >= 0:
            return self
        young = _Words(self.tok, self.most)
        young.older, self.older = self, {}
        return young


class WordEncoder:
    """Ids of texts by ``tokenizers``, with the ids of words remembered where white space divides words.

    A vocabulary divides so if white space of any length becomes one blank, belongs to no token, and
    no other step looks across it; then a text's ids are its words' ids. A new word of plain
    letters, with or without closing marks, goes to the library's model at once, as its other steps
    only lower the case and write bytes as letters; any other goes through all steps. All other
    vocabularies encode whole texts. Words live in two generations of ``most_bytes`` each; long
    words are not kept.
    """

    def __init__(self, path: str, most_bytes: int = 110 << 20):
        self.plain, self.words = Encoder(path), None
        if path.endswith(".model"):
            self.most_id = self.plain._piece.get_piece_size() - 1
            return
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.most_id = max([*spec["model"]["vocab"].values(), *[t["id"] for t in spec.get("added_tokens", [])]])
        if self.plain._tok is not None and _divides(spec):
            self.words = _Words(self.plain._tok, most_bytes)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's end.

        Arrow divides the texts into words and numbers the different ones; each of these is looked
        up once, and the texts' ids are gathered from theirs.
        """
        if self.words is None:
            every = [self.plain.ids(t) for t in texts.to_pylist()]
            return np.fromiter(itertools.chain(*every), np.uint32), np.cumsum([len(x) for x in every], dtype=np.int64)
        for c in "\n\t":
            texts = pc.replace_substring(texts, c, " ")
        divided = pc.split_pattern(texts, " ")
        coded = divided.flatten().dictionary_encode()
        raws = list(map(self.words.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist()))
        self.words = self.words.renewed()
        flat, sizes = np.frombuffer(b"".join(raws), np.uint32), np.fromiter(map(len, raws), np.int64, len(raws)) // 4
        starts, at = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        own = sizes[at]
        ends = np.cumsum(own)
        ids = flat[np.repeat(starts[at] - (ends - own), own) + np.arange(ends[-1] if len(ends) else 0)]
        lists = divided.offsets.to_numpy()[1:] - divided.offsets[0].as_py()
        return ids, np.append(0, ends)[lists]


def _divides(spec: dict) -> bool:
    normal = (spec.get("normalizer") or {}).get("normalizers", [])
    steps = [(x["type"], x.get("pattern"), x.get("content")) for x in normal]
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = pre[0] if pre else {}
    pattern = split.get("pattern", {}).get("Regex", "")
    return (
        ("Replace", {"Regex": r"\s+"}, " ") in steps
        and {x[0] for x in steps} <= {"NFC", "Replace", "Lowercase"}
        and sum(x[0] == "Replace" for x in steps) == 1
        and split.get("type") == "Split"
        and split.get("behavior") == "Removed"
        and bool(split.get("invert"))
        and [p for p in pattern.split("|") if " " in p or r"\s" in p.replace(r"[^\s", "") or "." in p or "(" in p] == []
        and all(x["type"] == "ByteLevel" and not x.get("use_regex") and not x.get("add_prefix_space") for x in pre[1:])
        and not any(c.isspace() for t in spec.get("added_tokens", []) for c in t["content"])
    )


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    """One for each vocabulary file and worker process."""
    return WordEncoder(path)
