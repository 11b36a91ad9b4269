"""Cost-balanced packing of documents into fixed-length training sequences.

A piece of n tokens costs ``linear * n + quadratic * n * n``: the second term is attention,
which stays within a piece. Pieces are taken in descending cost and each goes to the sequence
that costs least so far among those with room for it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from brightledger.llm.ids import encoder

CAPACITY = 2048
END_ID = 1
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
BLOCK_BYTES = 4 << 20  # of text

_FIELDS = [("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
_PLACED = [("sequence_id", pa.int64()), ("offset", pa.int64()), ("cost", pa.float64())]


def assign(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(piece, from, length, sequence, offset) of each part of each piece of 1 to
    ``capacity`` tokens, over just enough sequences for all tokens.

    A piece that no sequence has room for is cut: the sequence of least cost that is not
    full takes what fits, and the rest is placed in the same way; so the empty places left
    are fewer than one sequence, whatever the lengths are.
    """
    count = -(-int(lengths.sum()) // capacity)
    cost, used = np.zeros(count), np.zeros(count, np.int64)
    parts = []
    for piece in np.argsort(-lengths, kind="stable"):
        begin, left = 0, int(lengths[piece])
        while left:
            fits = np.flatnonzero(capacity - used >= left)
            if not len(fits):
                fits = np.flatnonzero(used < capacity)
            at = fits[np.argmin(cost[fits])]
            n = min(left, capacity - int(used[at]))
            parts.append((int(piece), begin, n, int(at), int(used[at])))
            used[at] += n
            cost[at] += linear * n + quadratic * n * n
            begin, left = begin + n, left - n
    return parts


def pack(
    documents: DataFrame,
    tokenizer: str,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pieces of whole documents (doc_id, text), one row each: all other columns, ``start``
    (ids of the document before the piece), ``length``, ``doc_tokens``, ``ids`` (binary,
    little-endian unsigned 32-bit), ``sequence_id``, ``offset`` and ``cost`` (of the sequence).

    The text itself is dropped. Input columns with these names, in any case, are dropped too. A null or
    empty text is the end id alone; repeated rows are packed each; ties between equal lengths
    follow the order of (doc_id, start); an empty table gives no rows.

    Documents are cut every ``capacity`` ids where they are encoded. The pieces are dealt out
    by a hash of their document's number in the input, one block on for each further piece,
    into blocks of a bounded number of text bytes, so no id, source, group of copies or long
    document fills one. Each block is packed on its own, and only its last sequence is not
    full. A sequence id is the block and a number within it.
    """
    outer = [f for f in documents.schema.fields if f.name.lower() not in {n for n, _ in _FIELDS + _PLACED} | {"text", "packing_block", "packing_number"}]
    names = [f.name for f in outer]
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    total = documents.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    number = F.monotonically_increasing_id()
    texts = documents.select(
        *[F.col(f"`{n}`") for n in names],
        "text",
        number.alias("packing_number"),
        F.pmod(F.xxhash64(number), F.lit(blocks)).alias("packing_block"),
    )
    long, double = T.LongType(), T.DoubleType()
    types = {"start": long, "length": long, "doc_tokens": long, "ids": T.BinaryType(), "sequence_id": long, "offset": long, "cost": double}
    schema = T.StructType([*outer, *[T.StructField(n, t) for n, t in types.items()]])
    cut_schema = T.StructType([*schema.fields[: len(names) + len(_FIELDS)], T.StructField("packing_number", long), T.StructField("packing_block", long)])
    cost_of = lambda n: linear * n + quadratic * n * n

    def cut(batches):
        for batch in batches:
            rows, start, length, tokens, ids, block = [], [], [], [], [], []
            dealt = batch.column("packing_block").to_pylist()
            for row, text in enumerate(batch.column("text")):
                of_text = encoder(tokenizer).encode(text.as_py(), end_id)
                for n, begin in enumerate(range(0, len(of_text), capacity)):
                    piece = of_text[begin : begin + capacity]
                    rows.append(row)
                    start.append(begin)
                    length.append(len(piece))
                    tokens.append(len(of_text))
                    ids.append(piece.tobytes())
                    block.append((dealt[row] + n) % blocks)
            made = [pa.array(v, t) for v, (_, t) in zip((start, length, tokens, ids), _FIELDS)]
            taken = pa.array(rows, pa.int64())
            outer_columns = [batch.column(n).take(taken) for n in names]
            number_column = batch.column("packing_number").take(taken)
            columns = [*outer_columns, *made, number_column, pa.array(block, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, cut_schema.names)
        encoder(tokenizer).forget()

    def place(block: tuple, table: pa.Table) -> pa.Table:
        first = [(n, "ascending") for n in names if n == "doc_id"]
        table = table.sort_by([*first, ("packing_number", "ascending"), ("start", "ascending")])
        parts = assign(table["length"].to_numpy(), capacity, linear, quadratic)
        piece, begin, length, sequence, offset = np.array(parts, np.int64).T
        costs = np.bincount(sequence, weights=cost_of(length.astype(float)))
        found = table.take(pa.array(piece))
        ids = [i[4 * b : 4 * (b + n)] for i, b, n in zip(found["ids"].to_pylist(), begin, length)]
        put = {
            "start": pa.array(found["start"].to_numpy() + begin),
            "length": pa.array(length),
            "ids": pa.array(ids, pa.binary()),
            "sequence_id": pa.array((block[0].as_py() << 32) + sequence),
            "offset": pa.array(offset),
            "cost": pa.array(costs[sequence]),
        }
        return pa.table([put[n] if n in put else found[n] for n in schema.names], names=schema.names)

    return texts.mapInArrow(cut, cut_schema).groupBy("packing_block").applyInArrow(place, schema)
