"""Token-id files under a Re-Pair grammar: frequent id pairs become nonterminals, again and again, per shard.

A file set is a Parquet folder with one row per shard. Documents lie in ascending id order, each closed by the end id:

* ``doc_ids``, and per document ``doc_symbols`` (symbols before it in the shard) and ``doc_tokens`` (ids before it);
  both have a last entry for the shard's end
* ``left, right``: the pair behind nonterminal ``base + i``; both parts are smaller than it
* ``lengths``: ids that nonterminal ``base + i`` expands to
* ``symbols``: the shard's ids and nonterminals after all replacements, 16 or 32 bits wide (``width``)

No pair crosses the end of a document, so a document is decoded alone; the expansion lengths lead to any id inside
it without decoding what comes before (``decode_range``).

Each round counts all pairs of the shard, takes the most frequent ones such that no symbol is the right part of one
and the left part of another, and replaces them together from left to right.

Edge cases: a null text is an empty one (only the end id is stored); null ids come first; repeated rows are stored
each; an empty table gives an empty file set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowmill.llm.shingles import slices
from rowmill.llm.tokens import copied, id_encoder, vocabulary_size
from rowmill.llm.workers import returning_memory

SHARD_IDS = 2_000_000
SLICE_BYTES = 16 << 20  # of text encoded at once
ROUNDS = 5
PAIRS_PER_ROUND = 3_000
LEAST_COUNT = 16
END_ID = 0
SHARD_SCHEMA = (
    "part int, shard int, n_ids long, base int, width int, doc_ids array<long>, doc_symbols array<long>, doc_tokens array<long>, "
    "left binary, right binary, lengths binary, symbols binary, rounds array<int>"
)


def choose_pairs(codes: np.ndarray, counts: np.ndarray, bits: int, most: int) -> np.ndarray:
    """The most frequent pairs such that left and right parts of different pairs are different symbols."""
    order = np.argsort(-counts, kind="stable")[: 8 * most]
    lefts: set[int] = set()
    rights: set[int] = set()
    chosen = []
    low = (1 << bits) - 1
    for code in codes[order].tolist():
        a, b = code >> bits, code & low
        if a == b:
            if a in lefts or a in rights:
                continue
        elif a in rights or b in lefts:
            continue
        lefts.add(a)
        rights.add(b)
        chosen.append(code)
        if len(chosen) == most:
            break
    return np.array(chosen, codes.dtype)


def compress(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Symbols, document ends in symbols, left and right parts of the rules, and the rules after each round."""
    symbols, left, right, rounds = ids, np.zeros(0, np.uint32), np.zeros(0, np.uint32), []
    for _ in range(ROUNDS):
        room = 65_536 - base - len(left) if base <= 65_536 else PAIRS_PER_ROUND
        if len(symbols) < 2 or room <= 0:
            break
        bits = 16 if base + len(left) <= 65_536 else 32
        wide = np.uint32 if bits == 16 else np.uint64
        codes = (symbols[:-1].astype(wide) << wide(bits)) | symbols[1:].astype(wide)
        inner = np.ones(len(codes), bool)
        inner[ends[ends < len(symbols)] - 1] = False
        kinds, counts = np.unique(codes[inner], return_counts=True)
        often = counts >= LEAST_COUNT
        pairs = choose_pairs(kinds[often], counts[often], bits, min(PAIRS_PER_ROUND, room))
        if not len(pairs):
            break
        low = wide((1 << bits) - 1)
        order = np.argsort(pairs)
        in_order = pairs[order]
        as_left = np.zeros(base + len(left), bool)
        as_right = np.zeros(base + len(left), bool)
        as_left[(pairs >> wide(bits)).astype(np.int64)] = True
        as_right[(pairs & low).astype(np.int64)] = True
        at = np.flatnonzero(inner & as_left[symbols[:-1]] & as_right[symbols[1:]])
        found = np.minimum(np.searchsorted(in_order, codes[at]), len(pairs) - 1)
        rule = order[found]
        hit = pairs[rule] == codes[at]
        at, rule = at[hit], rule[hit]
        # Overlaps occur only in runs of one symbol: every second place of a run counts.
        starts = np.concatenate([[True], np.diff(at) > 1]) if len(at) else np.zeros(0, bool)
        in_run = np.arange(len(at)) - np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        at, rule = at[in_run % 2 == 0], rule[in_run % 2 == 0]
        replaced = symbols.astype(np.uint32)
        replaced[at] = base + len(left) + rule
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        before = np.concatenate([[0], np.cumsum(stay)])
        symbols, ends = replaced[stay], before[ends]
        left = np.concatenate([left, (pairs >> wide(bits)).astype(np.uint32)])
        right = np.concatenate([right, (pairs & low).astype(np.uint32)])
        rounds.append(len(left))
    return symbols, ends, left, right, rounds


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, base: int, rounds: list[int]) -> np.ndarray:
    """Undo the rounds, last first: parts of a rule come from earlier rounds. Of many symbols, rules are expanded once each."""
    symbols = symbols.astype(np.uint32)
    if len(symbols) > base + len(left):
        of_rules = expand(np.arange(base, base + len(left)), left, right, base, rounds)
        ids = np.concatenate([np.arange(base, dtype=np.uint32), of_rules])
        return copied(ids, np.concatenate([np.ones(base, np.int64), rule_lengths(left, right, base, rounds)]), symbols)[0]
    for since in reversed([0, *rounds[:-1]] if rounds else []):
        rule = symbols >= base + since
        if not rule.any():
            continue
        place = np.arange(len(symbols)) + np.concatenate([[0], np.cumsum(rule)[:-1]])
        out = np.empty(len(symbols) + int(rule.sum()), np.uint32)
        which = symbols[rule].astype(np.int64) - base
        out[place[~rule]] = symbols[~rule]
        out[place[rule]] = left[which]
        out[place[rule] + 1] = right[which]
        symbols = out
    return symbols


def rule_lengths(left: np.ndarray, right: np.ndarray, base: int, rounds: list[int]) -> np.ndarray:
    lengths = np.ones(base + len(left), np.uint32)
    for since, until in zip([0, *rounds], rounds):
        lengths[base + since : base + until] = lengths[left[since:until]] + lengths[right[since:until]]
    return lengths[base:]


def _shard_row(part: int, shard: int, doc_ids: list, chunks: list[np.ndarray], base: int) -> pa.RecordBatch:
    ids = np.concatenate(chunks)
    tokens = np.concatenate([[0], np.cumsum([len(c) for c in chunks])]).astype(np.int64)
    symbols, ends, left, right, rounds = compress(ids, tokens[1:], base)
    width = 16 if base + len(left) <= 65_536 else 32
    row = {
        "part": part, "shard": shard, "n_ids": len(ids), "base": base, "width": width, "doc_ids": doc_ids,
        "doc_symbols": [0, *ends.tolist()], "doc_tokens": tokens.tolist(), "left": left.astype("<u4").tobytes(), "right": right.astype("<u4").tobytes(),
        "lengths": rule_lengths(left, right, base, rounds).astype("<u4").tobytes(), "symbols": symbols.astype(f"<u{width // 8}").tobytes(), "rounds": rounds,
    }
    kinds = {"part": pa.int32(), "shard": pa.int32(), "n_ids": pa.int64(), "base": pa.int32(), "width": pa.int32(), "rounds": pa.list_(pa.int32())}
    kinds |= {n: pa.list_(pa.int64()) for n in ("doc_ids", "doc_symbols", "doc_tokens")} | {n: pa.binary() for n in ("left", "right", "lengths", "symbols")}
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[k]) for k, v in row.items()], list(row))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, shard_ids: int = SHARD_IDS, end_id: int = END_ID) -> None:
    """Encode every text, close it with ``end_id`` and write the file set to ``path``."""
    base = vocabulary_size(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, shard = id_encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids, chunks, size = [], [], 0
        for batch in batches:
            for begin, end in slices(batch.column(1), SLICE_BYTES):
                ids, ends = encoder.encode_column(batch.column(1).slice(begin, end - begin))
                closed = np.split(np.insert(ids, ends, end_id), ends[:-1] + np.arange(1, len(ends)))
                for doc_id, of_doc in zip(batch.column(0).slice(begin, end - begin).to_pylist(), closed):
                    doc_ids.append(doc_id)
                    chunks.append(of_doc)
                    size += len(of_doc)
                    if size >= shard_ids:
                        yield _shard_row(part, shard, doc_ids, chunks, base)
                        doc_ids, chunks, size, shard = [], [], 0, shard + 1
        if doc_ids:
            yield _shard_row(part, shard, doc_ids, chunks, base)

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    rows.mapInArrow(returning_memory(run), SHARD_SCHEMA).write.parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """Ids before each shard. One small row per shard."""
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("part", "shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("shard_start"))


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (*(np.frombuffer(row[n], "<u4") for n in ("left", "right", "lengths")), np.frombuffer(row["symbols"], f"<u{row['width'] // 8}"))


def decode_document(row: dict, k: int) -> np.ndarray:
    """Ids of the shard's document number ``k``, its end id included."""
    left, right, _, symbols = _arrays(row)
    return expand(symbols[row["doc_symbols"][k] : row["doc_symbols"][k + 1]], left, right, row["base"], row["rounds"])


def decode_range(row: dict, begin: int, end: int) -> np.ndarray:
    """Ids ``begin`` to ``end`` (without it) of a shard, expanding only the symbols that cover them."""
    left, right, lengths, symbols = _arrays(row)
    ids_of = np.where(symbols >= row["base"], lengths[np.maximum(symbols.astype(np.int64) - row["base"], 0)] if len(lengths) else 1, 1)
    at = np.concatenate([[0], np.cumsum(ids_of, dtype=np.int64)])
    first = int(np.searchsorted(at, begin, "right")) - 1
    last = int(np.searchsorted(at, end, "left"))
    return expand(symbols[first:last], left, right, row["base"], row["rounds"])[begin - at[first] : end - at[first]]


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            left, right, _, symbols = _arrays(row)
            ids = expand(symbols, left, right, row["base"], row["rounds"]).astype("<u4")
            at = row["doc_tokens"]
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            n = len(sums)
            columns = [
                pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                pa.array(at[:-1], pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(sums, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["part", "shard", "doc_id", "in_shard", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document, decoded: ``doc_id, start, n_tokens, ids_crc32``."""
    shards = spark.read.parquet(path)
    schema = "part int, shard int, doc_id long, in_shard long, n_tokens long, ids_crc32 long"
    decoded = shards.drop("n_ids").mapInArrow(returning_memory(_documents), schema)
    return decoded.join(shard_starts(shards), ["part", "shard"]).select("doc_id", (F.col("shard_start") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32")
