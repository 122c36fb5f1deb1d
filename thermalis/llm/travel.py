"""Homes: chunks of documents that are visited twice, first to ask and then to be answered.

Documents travel to their home in compressed packs of many rows. A home is a fixed share of the ids, some MB of text.
"""

import pickle

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermalis.llm.common import handed_back

#: Text bytes of a home, and the fewest homes, so that small inputs use all cores too.
HOME_BYTES = 8 << 20
LEAST_HOMES = 48
#: A task packs a home's rows once it holds so many bytes of them, and all once it holds HELD.
PACK = 512 << 10
HELD = 48 << 20
LEVEL = 6


def number_of_homes(docs: DataFrame, content: Column) -> int:
    total = docs.agg(F.sum(F.octet_length(content))).first()[0] or 0
    return max(LEAST_HOMES, -(-total // HOME_BYTES))


def home_of(key: Column, content: Column | None, n: int) -> Column:
    """The home of a key; without a key, that of the content."""
    spread = F.xxhash64(key)
    if content is not None:
        spread = F.when(key.isNull(), F.xxhash64(content)).otherwise(spread)
    return F.pmod(spread, F.lit(n)).cast("int")


def sent_home(rows: DataFrame) -> DataFrame:
    """home, pack from rows whose first column is home: packs hold the other columns of some rows."""
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        held, sizes = {}, {}

        def packed(homes):
            packs = [squeeze(pickle.dumps(held.pop(h), 5)) for h in homes]
            for h in homes:
                del sizes[h]
            return pa.RecordBatch.from_arrays([pa.array(homes, pa.int32()), pa.array(packs, pa.binary())],
                                              names=["home", "pack"])

        for batch in batches:
            for home, *values in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(home, []).append(tuple(values))
                sizes[home] = sizes.get(home, 0) + 64 + sum(len(v) for v in values if isinstance(v, bytes))
            full = [h for h, s in sizes.items() if s >= PACK]
            if sum(sizes.values()) >= HELD:
                full = list(sizes)
            if full:
                yield packed(full)
        if sizes:
            yield packed(list(sizes))

    return rows.mapInArrow(handed_back(run), "home int, pack binary")


def rows_at_home(packs: pa.Table):
    """The rows of a home's packs, one pack in memory at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    for pack in packs.column("pack"):
        yield from pickle.loads(unpack(pack.as_py()))
