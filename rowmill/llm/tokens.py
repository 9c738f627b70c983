"""Token ids and token counts of whole texts, from a public tokenizer file.

Texts are cut at safe boundaries only: places where the tokenizer never joins what lies on both sides. The pieces
repeat far more often than texts do. For ids, each piece of a slice of texts is encoded once. For counts, each task encodes
a piece once and keeps the result, in two generations of about ``CACHED_BYTES``: pieces in use move to the new one. A task's
pieces go with the task. Results equal those of encoding the whole text.

Edge cases: a null text is an empty one; an empty text has no tokens; null and repeated ids are kept as they are.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from rowmill.llm.shingles import slices

CACHED_BYTES = 64 << 20  # of one generation: pieces, results and what Python adds to either
PIECE_COST = 200  # bytes of two objects and an entry
SLICE_BYTES = 4 << 20
PIECES_AT_ONCE = 2_000
COPIED_AT_ONCE = 200_000
_OPEN_SPACE = re.compile(r" \s|\s |^ | $")
_SPACE = re.compile(r"\s")
_SAFE_SPACE = re.compile(r"(?<=\S)(?= \S)")
# The same for Arrow, whose regular expressions know ASCII white space only.
_SPACE_RE2 = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_OPEN_SPACE_RE2 = rf" {_SPACE_RE2}|{_SPACE_RE2} |\A | \z"
_FAR_LETTERS = "À-ÖØ-öø-ſΑ-ΡΣ-Ωα-ωЀ-ҁҊ-ӿ"  # long known letters; others are left to the tokenizer
_PLAIN_PIECE_RE2 = rf"\A[!-&(-~{_FAR_LETTERS}]+(\n[!-&(-~{_FAR_LETTERS}]+)*\z"
_RUN_RE2 = rf"([A-Za-z{_FAR_LETTERS}]+|[0-9]+|\n|[^A-Za-z0-9\n{_FAR_LETTERS}]+)"


_loaded: dict[str, object] = {}


def load_tokenizer(path: str):
    """The tokenizer, read once per process."""
    if path in _loaded:
        return _loaded[path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    _loaded[path] = tokenizer
    return tokenizer


def vocabulary_size(path: str) -> int:
    return load_tokenizer(path).get_vocab_size(with_added_tokens=True)


class PieceCache:
    """What ``value`` makes of the encoding of each piece, with ``before`` put in front of it."""

    def __init__(self, tokenizer, before: str, value: Callable):
        self.tokenizer, self.before, self.value = tokenizer, before, value
        self.known: dict[str, object] = {}
        self.old: dict[str, object] = {}
        self.size = 0

    def learn(self, pieces: set[str]) -> Callable[[str], object]:
        """A look-up that holds at least the given pieces."""
        if self.size > CACHED_BYTES:
            self.known, self.old, self.size = {}, self.known, 0
        unseen = pieces.difference(self.known)
        again = unseen.intersection(self.old)
        self.known.update((p, self.old[p]) for p in again)
        missing = list(unseen - again)
        self.size += sum(map(len, unseen)) * 2 + PIECE_COST * len(unseen)
        for begin in range(0, len(missing), 2_000):
            part = missing[begin : begin + 2_000]
            self.known.update(zip(part, self.encoded(part)))
        return self.known.__getitem__

    def encoded(self, pieces: list[str]) -> Iterator:
        return map(self.value, self.tokenizer.encode_batch_fast([self.before + p for p in pieces], add_special_tokens=False))


class IdEncoder:
    """Ids of texts, for byte-level tokenizers that put a space before its word.

    A boundary is safe before a single space between two characters that are not white space. Each distinct piece of a
    call is encoded once, and its ids are copied to all its places.

    Most pieces are printable ASCII and European letters without apostrophes, added tokens or other white space than single
    line breaks. What the tokenizer makes words of in them are the runs of letters, of digits and of other signs, the space
    before the first one. Distinct runs go straight to the tokenizer's model.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.runs = _model_on_runs(self.tokenizer)

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The text's pieces; all but the first without the space before them."""
        if not _OPEN_SPACE.search(text):
            return text.split(" ")
        first, *later = _SAFE_SPACE.split(text)
        return [first, *[p[1:] for p in later]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        ids, ends = self.encode_column(pa.array(texts, pa.large_string()))
        return [part.tobytes() for part in np.split(ids, ends[:-1])] if len(texts) else []

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text ends in them."""
        cut = self._cut(pc.fill_null(texts.cast(pa.large_string()), ""))
        return _by_kind(cut, lambda pieces, opens: self._piece_ids(pieces, "" if opens else " "))

    def _cut(self, texts: pa.Array) -> pa.Array:
        open_space = pc.match_substring_regex(texts, _OPEN_SPACE_RE2)
        odd = open_space.to_numpy(zero_copy_only=False)
        if not odd.any():
            return pc.split_pattern(texts, " ")
        plain = pc.split_pattern(texts.filter(pc.invert(open_space)), " ")
        rest = pa.array([self.pieces(t) for t in texts.filter(open_space).to_pylist()], plain.type)
        return pa.concat_arrays([plain, rest]).take(pa.array(np.argsort(np.argsort(odd, kind="stable"))))

    def _piece_ids(self, pieces: pa.Array, before: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has."""
        plain = np.full(len(pieces), self.runs is not None)
        if self.runs is not None:
            plain &= pc.match_substring_regex(pieces, _PLAIN_PIECE_RE2).to_numpy(zero_copy_only=False)
            for content in self.added:
                plain &= ~pc.match_substring(pieces, content).to_numpy(zero_copy_only=False)
        by_runs, run_lengths = self._by_runs(pieces.filter(pa.array(plain)), before)
        others = self._by_whole(pieces.filter(pa.array(~plain)).to_pylist(), before)
        places = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        lengths = np.concatenate([run_lengths, np.array([len(o) // 4 for o in others], np.int64)])
        ids = np.concatenate([by_runs, np.frombuffer(b"".join(others), np.uint32)])
        back = np.argsort(places)
        return copied(ids, lengths, back)[0], lengths[back]

    def _by_runs(self, pieces: pa.Array, before: str) -> tuple[np.ndarray, np.ndarray]:
        spaced = pc.utf8_rtrim(pc.replace_substring_regex(pieces, _RUN_RE2, "\\1 "), " ")
        ids, ends = _by_kind(pc.split_pattern(spaced, " "), lambda words, opens: self._word_ids(words, before if opens else ""))
        return ids, np.diff(ends, prepend=0)

    def _word_ids(self, words: pa.Array, before: str) -> tuple[np.ndarray, np.ndarray]:
        tokenize, spelled = self.runs
        lead, far = spelled.get(before, ""), {ord(c): s for c, s in spelled.items()}
        ids, sizes = array("I"), array("q")
        for word in words.to_numpy(zero_copy_only=False):
            found = tokenize(lead + (word if word.isascii() and word != "\n" else word.translate(far)))
            ids.extend([token.id for token in found])
            sizes.append(len(found))
        return np.array(ids, np.uint32), np.array(sizes, np.int64)

    def _by_whole(self, pieces: list[str], before: str) -> list[bytes]:
        """Ids of pieces by the whole tokenizer. Pieces after a space are encoded as lines of one text, which costs less
        than one by one: a line break before a space is a token of its own. Pieces with white space are encoded singly."""
        alone = [not before or not p or _SPACE.search(p) is not None for p in pieces]
        known: dict[str, bytes] = {}
        for single in (True, False):
            kind = [p for p, a in zip(pieces, alone) if a == single]
            for begin in range(0, len(kind), PIECES_AT_ONCE):
                part = kind[begin : begin + PIECES_AT_ONCE]
                known.update(zip(part, self._singly(part, before) if single else self._as_lines(part)))
        return [known[p] for p in pieces]

    def _singly(self, pieces: list[str], before: str) -> Iterator[bytes]:
        return (array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast([before + p for p in pieces], add_special_tokens=False))

    def _as_lines(self, pieces: list[str]) -> Iterator[bytes]:
        if len(self.line_break) != 1:
            return self._singly(pieces, " ")
        ids = np.array(self.tokenizer.encode_batch_fast([" " + "\n ".join(pieces)], add_special_tokens=False)[0].ids, "<u4")
        breaks = np.flatnonzero(ids == self.line_break[0]) * 4
        if len(breaks) != len(pieces) - 1:
            return self._singly(pieces, " ")
        raw = ids.tobytes()
        return (raw[a:b] for a, b in zip([0, *(breaks + 4).tolist()], [*breaks.tolist(), len(raw)]))


def _model_on_runs(tokenizer) -> tuple[Callable, dict[str, str]] | None:
    """What makes tokens of a word, and how white space and far letters are spelled in words; None if the tokenizer does
    not make its words of the runs."""
    from tokenizers import pre_tokenizers

    described = json.loads(tokenizer.to_str())
    cutter = described["pre_tokenizer"] or {}
    byte_level = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space")
    if not byte_level or described["normalizer"] or described["model"].get("dropout"):
        return None
    bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    far = [chr(c) for c in range(0x80, 0x500) if re.match(f"[{_FAR_LETTERS}]", chr(c))]
    return tokenizer.model.tokenize, {c: bytewise.pre_tokenize_str(c)[0][0] for c in [" ", "\n", *far]}


def _by_kind(lists: pa.Array, ids_of: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all parts of all lists one after the other, and where each list ends in them.

    ``ids_of`` encodes the distinct parts that open a list, then the distinct others: their ids, and how many each has.
    """
    n_parts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = lists.flatten()
    opens = np.zeros(len(parts), bool)
    opens[np.cumsum(n_parts) - n_parts] = True
    codes, ids, sizes = np.empty(len(parts), np.int32), [], []
    for which, places in ((True, opens), (False, ~opens)):
        kinds = parts.filter(pa.array(places)).dictionary_encode()
        codes[places] = kinds.indices.to_numpy() + sum(map(len, sizes))
        kinds = kinds.dictionary  # the places of the parts are known: only their kinds are needed from here on
        if not which:
            del lists, parts
        found, lengths = ids_of(kinds, which)
        ids.append(found)
        sizes.append(lengths)
    out, ends = copied(np.concatenate(ids), np.concatenate(sizes), codes)
    return out, np.concatenate([[0], ends])[np.cumsum(n_parts)]


def copied(ids: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the kinds named by ``codes``, and where each ends."""
    starts, ends = np.cumsum(sizes) - sizes, np.cumsum(sizes[codes])
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    for begin in range(0, len(codes), COPIED_AT_ONCE):
        some = slice(begin, begin + COPIED_AT_ONCE)
        lengths = sizes[codes[some]]
        to = ends[begin] - lengths[0]
        moved = np.repeat(starts[codes[some]] - (ends[some] - lengths), lengths)
        out[to : to + len(moved)] = ids[moved + np.arange(to, to + len(moved))]
    return out, ends


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens``, for tokenizers that drop white space (it bounds every token)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _counting_cache(path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            sizes = pc.binary_length(texts).cast(pa.int64())
            for begin, end in slices(texts, SLICE_BYTES):
                cut = [t.replace("\n", " ").split(" ") for t in texts.slice(begin, end - begin).to_pylist()]
                count = cache.learn({p for c in cut for p in c})
                counts = [sum(map(count, c)) for c in cut]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), sizes.slice(begin, end - begin), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def _counting_cache(path: str) -> PieceCache:
    return PieceCache(load_tokenizer(path), "", len)


def id_encoder(path: str) -> IdEncoder:
    return IdEncoder(path)
