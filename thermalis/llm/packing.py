"""Token ids packed into rows of equal length by best fit decreasing.

Within a home (see travel) documents become token ids with an end mark. Documents longer than a row are cut into full
rows and a rest, so no token is lost; rests and short documents go, longest first, into the row with the least room
that holds them. A segment tree over the rooms 0 to row length finds that room.
"""

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermalis.llm.common import bounded_batches, scratch_path, text_bytes
from thermalis.llm.travel import home_of, number_of_homes, rows_at_home, sent_home

ROW = 2048
ROWS = ("home int, row int, ids binary, n_tokens int, doc_ids array<long>, doc_starts array<long>, "
        "cu_seqlens array<int>, position_resets array<int>")


class Rooms:
    """Rows by the room that is left in them; the tree counts the rows below each node."""

    def __init__(self, row: int):
        self.size = 1 << row.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(row + 1)]

    def change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self.change(room, 1)

    def take(self, room: int) -> int:
        self.change(room, -1)
        return self.rows[room].pop()

    def least(self, wanted: int) -> int | None:
        """The least room of at least `wanted` that a row has."""
        node = wanted + self.size
        while not self.count[node]:
            while node & 1:  # up from right children, then to the right neighbour
                node >>= 1
            if not node:
                return None
            node += 1
            if not node & (node - 1):  # the next level begins: nothing to the right
                return None
        while node < self.size:
            node *= 2
            if not self.count[node]:
                node += 1
        return node - self.size


def best_fit(lengths: list[int], row: int) -> list[int]:
    """Row of each piece; pieces go longest first, equal ones in their order."""
    rooms, rows, n = Rooms(row), [0] * len(lengths), 0
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = rooms.least(lengths[piece])
        if room is None:
            at, room, n = n, row, n + 1
        else:
            at = rooms.take(room)
        rows[piece] = at
        rooms.put(room - lengths[piece], at)
    return rows


def pack_home(documents, row: int, pad: int):
    """Packed rows of (key, ids): (ids, keys, starts, lengths) each; ids are filled up with pad."""
    pieces = []
    for key, ids in documents:
        for start in range(0, len(ids), row):
            pieces.append((key, start, ids[start:start + row]))
    rows: dict[int, list] = {}
    for piece, at in zip(pieces, best_fit([len(p[2]) for p in pieces], row)):
        rows.setdefault(at, []).append(piece)
    for at in sorted(rows):
        parts = rows[at]
        filled = np.full(row, pad, pieces[0][2].dtype)
        held = np.concatenate([p[2] for p in parts])
        filled[:len(held)] = held
        yield filled, [p[0] for p in parts], [p[1] for p in parts], [len(p[2]) for p in parts]


def pack(docs: DataFrame, ranks: dict[bytes, int], pattern: str, end: int, row: int = ROW, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """home, row, ids, n_tokens, doc_ids, doc_starts, cu_seqlens, position_resets: a row per packed row.

    ids: `row` little-endian integers, of 16 bits if the ids fit, else 32; those after n_tokens are `end`. Segment i
    holds tokens cu_seqlens[i] to cu_seqlens[i + 1] of the row, which are those from doc_starts[i] on of document
    doc_ids[i]; positions begin anew at position_resets. Every document ends with `end`, so null and empty texts have
    one token. Repeated rows are packed each; null ids stay null. Other columns are left out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast((ranks, pattern))
    kind = np.dtype("<u2") if max(max(ranks.values()), end) < 1 << 16 else np.dtype("<u4")

    def run(packs):
        encode = tiktoken.Encoding("packing", pat_str=shared.value[1], mergeable_ranks=shared.value[0],
                                   special_tokens={}).encode_ordinary
        documents = [(key, np.array([*encode(text.decode("utf-8", "replace")), end], kind)) for key, text in rows_at_home(packs)]
        documents.sort(key=lambda d: (d[0] is not None, d[0] or 0, d[1].tobytes()))
        home = packs.column("home")[0].as_py()
        out = {name: [] for name in ("home", "row", "ids", "n_tokens", "doc_ids", "doc_starts", "cu_seqlens", "position_resets")}
        for n, (ids, keys, starts, lengths) in enumerate(pack_home(documents, row, end)):
            ends = [0, *np.cumsum(lengths).tolist()]
            for name, value in zip(out, (home, n, ids.tobytes(), ends[-1], keys, starts, ends, ends[:-1])):
                out[name].append(value)
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                 pa.list_(pa.int32()), pa.list_(pa.int32()))
        return pa.table({name: pa.array(values, k) for (name, values), k in zip(out.items(), kinds)})

    content, key = text_bytes(text_column), F.col(id_column).cast("long")
    home = home_of(key, content, number_of_homes(docs, content))
    packs = sent_home(docs.select(home.alias("home"), key.alias("id"), content.alias("content")))
    return packs.groupBy("home").applyInArrow(run, ROWS)


def write_packed(packed: DataFrame, folder: str | None = None) -> DataFrame:
    """Write packed rows as a table in a shared folder and return it; a row's ids are one line of the id matrix."""
    folder = folder or scratch_path(packed.sparkSession, "packed")
    packed.write.parquet(folder)
    return packed.sparkSession.read.schema(packed.schema).parquet(folder)
