"""Cost-balanced packing of tokenized documents into sequences of fixed length.

Documents are tokenized and cut at multiples of the sequence length; such full pieces are
sequences of their own and go into no group. What is left of each document goes to a packing group, by hash, of a
bounded number of tokens. Within a group the pieces are taken by falling cost (linear plus
quadratic in their length), and each goes to the cheapest sequence that still has room. A piece
that fits nowhere is cut, so that only a share ``SLACK`` of each group is padding.

Groups hold lengths and checksums and not token ids, unless ids are asked for. A cut piece's CRC-32
is put together from checksums of blocks of ``GRID`` tokens.
"""

from __future__ import annotations

import gc
import math
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilode.llm.common import slices, stored

LENGTH = 2048
END_ID = 1
GRID = 32
SLACK = 0.002
GROUP_TOKENS = 1 << 21
# Parts of texts that a Python worker remembers, and as many again from before the last renewal.
CACHE_PARTS = 250_000
CHUNK = 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 1024


# Words, cut before ASCII punctuation that follows an ASCII letter or digit. The tokenizer cuts there
# anyway, so this changes no id and leaves far fewer different parts.
_PARTS = re.compile(
    rb"(?:[^a-z0-9\s]++[a-z0-9]*+|[a-z0-9]++)"
    rb"(?:[^a-z0-9\s.,!?#*$%&|;:][^a-z0-9\s]*+[a-z0-9]*+)*+").findall
# Words of letters that stay one piece before the merges: such words can be encoded many at a time.
_PLAIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
WORD_END = "</w>"
TOGETHER = 20


@cache
def _tokenizer(path: str | None):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one core

    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))


@contextmanager
def _uncollected() -> Iterator[None]:
    """No search for reference cycles meanwhile: there are none, and it goes through all known words."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


class _Places(dict):
    """Numbers the parts of a chunk in the order in which they are first met."""

    def __missing__(self, part: bytes) -> int:
        place = self[part] = len(self)
        return place


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and case and never joins across white space, nor across the cuts
    of ``_PARTS``, so each part is encoded once and remembered. Parts are numbered within a chunk of
    text first: most lookups then go to a small table, and one per part of the chunk to the large one.
    """

    def __init__(self, path: str | None = None):
        self.tokenizer = _tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def batch(self, texts: list[bytes | None]) -> Iterator[bytes]:
        part: list[list[bytes]] = []
        size = 0
        for text in texts:
            part.append(self._cut(text) if text else [])
            size += len(text or b"")
            if size >= CHUNK:
                yield from self._encode(part)
                part, size = [], 0
        yield from self._encode(part)

    @staticmethod
    def _cut(text: bytes) -> list[bytes]:
        # "<|" may begin a special token, which is matched as it is written
        return text.split() if b"<|" in text else _PARTS(text.lower())

    def _encode(self, docs: list[list[bytes]]) -> Iterator[bytes]:
        with _uncollected():
            places = _Places()
            found = [list(map(places.__getitem__, parts)) for parts in docs]
            self._learn(places)
            ids = list(map(self.known.__getitem__, places)).__getitem__
        for numbers in found:
            yield b"".join(map(ids, numbers))

    def _learn(self, parts: Iterable[bytes]) -> None:
        """Make the ids of these parts known; parts met again come back from the older ones."""
        if len(self.known) > CACHE_PARTS:
            self.older, self.known = self.known, {}
        known = self.known
        fresh = [p for p in parts if p not in known]
        known.update([(p, self.older[p]) for p in fresh if p in self.older])
        plain, other = [], []
        for part in fresh:
            if part not in known:
                (plain if part.isalpha() or _PLAIN.fullmatch(part) else other).append(part)
        groups = [plain[i:i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
        for group, ids in zip(groups, self._ids([b" ".join(g) for g in groups])):
            last = 4 * (np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 1)
            if len(last) == len(group):  # each word has one token that ends a word
                at = [0, *last.tolist()]
                known.update((w, ids[a:b]) for w, a, b in zip(group, at, at[1:]))
            else:
                other += group
        known.update(zip(other, self._ids(other)))

    def _ids(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]


@cache
def _encoder(path: str | None) -> Encoder:
    """One per Python worker, which goes from task to task and takes the known words along."""
    return Encoder(path)


def _crcs(data: bytes) -> list[int]:
    return [zlib.crc32(data[i:i + 4 * GRID]) for i in range(0, len(data), 4 * GRID)]


def _join_crc(first: int, second: tuple[int, int]) -> int:
    """CRC-32 of two runs of bytes from the CRC of each and the length of the second."""
    crc, size = second
    zeros = bytes(size)
    return zlib.crc32(zeros, first) ^ zlib.crc32(zeros) ^ crc


PIECE = ("start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ordinal bigint, "
         "blocks array<bigint>, ids binary")


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           length: int = LENGTH, end_id: int = END_ID, tokenizer_path: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """One row per piece before packing: full pieces, and a shorter rest with its block checksums.

    A null text counts as empty and has the end id alone.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ordinal = _encoder(tokenizer_path), 0
        end = np.array([end_id], "<u4").tobytes()
        schema = pa.schema([
            *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "ordinal")),
            ("blocks", pa.list_(pa.int64())), ("ids", pa.binary())])
        for batch in slices(batches):
            rows, owner = [], []
            for k, data in enumerate(encoder.batch(batch["text"].to_pylist())):
                data += end
                total = len(data) // 4
                for start in range(0, total, length):
                    part = data[4 * start:4 * (start + length)]
                    n = len(part) // 4
                    rows.append((start, n, zlib.crc32(part), total, ordinal,
                                 _crcs(part) if n < length and not with_ids else None,
                                 part if with_ids else None))
                    owner.append(k)
                ordinal += 1
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [
                pa.array([], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(owner, pa.int64())), *columns],
                names=["doc_id", *schema.names])

    return narrow.mapInArrow(cut, f"doc_id {kind}, {PIECE}")


def assign(lengths: np.ndarray, length: int, slack: float = SLACK, linear: float = LINEAR,
           quadratic: float = QUADRATIC, grid: int = GRID) -> list[tuple[int, int, int, int]]:
    """``(item, from, to, sequence)`` for pieces of the given lengths, by falling cost.

    Each goes whole to the cheapest sequence with room for it. If none has room, the roomiest
    takes as many whole blocks of ``grid`` as it can and the rest is placed on; a new sequence is
    opened when not even one block fits.
    """
    total = int(lengths.sum())
    count = max(1, math.ceil(total * (1 + slack) / length))
    # Opened sequences wait at the end of the arrays.
    spare = count // 8 + 8
    cost = np.concatenate([np.zeros(count), np.full(spare, np.inf)])
    room = np.concatenate([np.full(count, length), np.zeros(spare, np.int64)]).astype(np.int64)
    placed = []
    for item in np.argsort(-lengths, kind="stable"):
        start, end = 0, int(lengths[item])
        while start < end:
            n = end - start
            fits = np.where(room[:count] >= n, cost[:count], np.inf)
            best = int(fits.argmin())
            if not np.isfinite(fits[best]):
                best = int(room[:count].argmax())
                n = int(room[best]) // grid * grid
                if not n:
                    if count == len(room):
                        room, cost = np.append(room, 0), np.append(cost, np.inf)
                    room[count], cost[count] = length, 0.0
                    count += 1
                    continue
            placed.append((int(item), start, start + n, best))
            room[best] -= n
            cost[best] += linear * n + quadratic * n * n
            start += n
    return placed


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         end_id: int = END_ID, tokenizer_path: str | None = None, with_ids: bool = False,
         slack: float = SLACK, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every token of every row, and its end id, lies in exactly one piece; the pieces of a sequence
    fill it from offset 0 without a gap, up to ``length``. With ``with_ids`` a column ``ids`` has
    the token ids. Null and empty texts are one end id. Rows with a null or a repeated id are
    packed like any others. An empty table gives no rows. Other columns are not read.
    """
    cut = stored(
        pieces(docs, id_col, text_col, length, end_id, tokenizer_path, with_ids).withColumn(
            "place", F.monotonically_increasing_id()), "pieces")
    rest = cut.where(F.col("length") < length).drop("place")
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, math.ceil(tokens / group_tokens))
    group = F.pmod(F.xxhash64("doc_id", "start", "ordinal", "ids_crc32"), F.lit(groups))
    kind = cut.schema["doc_id"].dataType.simpleString()

    def place(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("ids_crc32", "ascending"), ("ordinal", "ascending"),
                               ("start", "ascending")])
        sizes = table["length"].to_numpy()
        base = key[0].as_py() << 32
        rows = assign(sizes, length, slack, grid=1 if with_ids else GRID)
        filled: dict[int, int] = {}
        out = []
        starts, crcs = table["start"].to_pylist(), table["ids_crc32"].to_pylist()
        for k, a, b, sequence in rows:
            crc, ids = crcs[k], None
            if with_ids:
                ids = table["ids"][k].as_py()[4 * a:4 * b]
                crc = zlib.crc32(ids)
            elif b - a < sizes[k]:
                blocks = table["blocks"][k].as_py()[a // GRID:-(-b // GRID)]
                left = [4 * min(GRID, b - a - i * GRID) for i in range(len(blocks))]
                crc = reduce(_join_crc, zip(blocks, left), 0)
            at = filled.get(sequence, 0)
            filled[sequence] = at + b - a
            out.append((starts[k] + a, b - a, crc, 2 * (base + sequence), at,
                        ids and np.frombuffer(ids, "<u4").tolist()))
        names = ("start", "length", "ids_crc32", "sequence_id", "offset")
        columns = list(zip(*out))
        at = pa.array([r[0] for r in rows], pa.int64())
        arrays = {"doc_id": table["doc_id"].take(at), "doc_tokens": table["doc_tokens"].take(at)}
        arrays |= {n: pa.array(c, pa.int64()) for n, c in zip(names, columns)}
        if with_ids:
            arrays["ids"] = pa.array(columns[5], pa.list_(pa.int64()))
        return pa.table({n: arrays[n] for n in [*OUT, *(["ids"] if with_ids else [])]})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            ids = [np.frombuffer(i, "<u4").tolist() for i in batch["ids"].to_pylist()]
            at = batch.schema.get_field_index("ids")
            yield batch.set_column(at, "ids", pa.array(ids, pa.list_(pa.int64())))

    names = [*OUT, *(["ids"] if with_ids else [])]
    schema = ", ".join(f"`{n}` {kind if n == 'doc_id' else 'bigint'}" for n in OUT)
    schema += ", ids array<bigint>" if with_ids else ""
    packed = rest.withColumn("group", group).groupBy("group").applyInArrow(place, schema)
    # a full piece is a sequence of its own, whose id is odd
    full = cut.where(F.col("length") == length).withColumns(
        {"sequence_id": F.lit(2) * F.col("place") + 1, "offset": F.lit(0).cast("bigint")}).select(*names)
    return packed.unionByName(full.mapInArrow(unpack, schema) if with_ids else full)


OUT = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
