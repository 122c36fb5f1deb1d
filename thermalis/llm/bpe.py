"""Byte-level BPE: encoding by segment trees over byte positions, and decoding.

A pre-token of n bytes starts as n byte tokens. Leaf i of its tree holds the rank of the pair that starts
at byte i, if a live token starts there; the root holds the lowest rank and, among equals, the leftmost
position. A merge changes three leaves (the merged token, its left neighbour, the token that goes), each
followed by updates up to the root. Short pre-tokens go through their trees side by side in numpy arrays,
one row per pre-token; long ones go through a tree of their own.

Every distinct piece of a partition is encoded once while it stays in a cache of bounded size.
"""

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermalis.llm.common import bounded_batches, handed_back, text_bytes

#: No pair here can merge.
NONE = np.int64(1) << np.int64(40)
#: Pre-tokens of more bytes have a tree of their own.
SHORT = 64
#: Rows that go through their trees side by side, so that they stay in the processor's cache.
TOGETHER = 2048
#: Cached pieces per worker, of about 200 bytes each.
CACHED = 150_000
#: Characters of texts that are encoded together.
SLICE = 512 << 10


class Vocabulary:
    """Merge ranks as arrays; small enough to travel with a task (a vocabulary file is about 1 MB)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.merged = np.fromiter(pairs.values(), np.int64, len(pairs))[order]
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.single < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        self.pieces = {rank: token for token, rank in ranks.items()}
        self._encoder = None

    def encoder(self) -> "Encoder":
        """The encoder that all tasks of one worker process share."""
        if self._encoder is None:
            self._encoder = Encoder(self)
        return self._encoder

    @classmethod
    def load(cls, path: str, pattern: str) -> "Vocabulary":
        """Read a .tiktoken file: lines of base64 token and rank. Read on the driver only."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return cls(ranks, pattern)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << np.int64(32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.merged[at], NONE)


def merge_together(vocabulary: Vocabulary, tokens: list[bytes], size: int) -> list[bytes]:
    """Ids of pre-tokens of 2 to size bytes (size: a power of 2), as little-endian 32-bit integers."""
    n = len(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, n)
    raw = np.frombuffer(b"".join(t.ljust(size, b"\0") for t in tokens), np.uint8).reshape(n, size)
    place = np.arange(size)
    ids = vocabulary.single[raw]
    ids[place >= lengths[:, None]] = -1
    after = np.where(place + 1 < lengths[:, None], place + 1, size).astype(np.int64)
    before = np.broadcast_to(place - 1, (n, size)).copy()
    tree = np.full((n, 2 * size), NONE * size, np.int64)
    ranks = vocabulary.pair_ranks(ids[:, :-1], np.maximum(ids[:, 1:], 0))
    live = place[1:] < lengths[:, None]
    tree[:, size:2 * size - 1] = np.where(live & (ranks < NONE), ranks * size + place[:-1], NONE * size)
    width = size // 2
    while width:
        tree[:, width:2 * width] = np.minimum(tree[:, 2 * width:4 * width:2], tree[:, 2 * width + 1:4 * width:2])
        width //= 2
    ids, after, before, tree = ids.ravel(), after.ravel(), before.ravel(), tree.ravel()

    def put(rows, leaf, value):
        node = rows * (2 * size)
        at = leaf + size
        tree[node + at] = value
        at = at >> 1
        while at[0]:
            tree[node + at] = np.minimum(tree[node + 2 * at], tree[node + 2 * at + 1])
            at = at >> 1

    rows = np.flatnonzero(tree[1::2 * size] < NONE * size)
    while len(rows):
        rank, at = np.divmod(tree[rows * (2 * size) + 1], size)
        base = rows * size
        gone = after[base + at]
        follower = after[base + gone]
        ids[base + at] = rank
        ids[base + gone] = -1
        after[base + at] = follower
        inner = follower < size
        before[(base + follower)[inner]] = at[inner]
        put(rows, gone, NONE * size)
        pair = np.where(inner, vocabulary.pair_ranks(rank, ids[np.where(inner, base + follower, 0)]), NONE)
        put(rows, at, np.where(pair < NONE, pair * size + at, NONE * size))
        left = before[base + at]
        led = left >= 0
        if led.any():
            some, left = rows[led], left[led]
            pair = vocabulary.pair_ranks(ids[some * size + left], rank[led])
            put(some, left, np.where(pair < NONE, pair * size + left, NONE * size))
        rows = rows[tree[rows * (2 * size) + 1] < NONE * size]
    kept = ids >= 0
    counts = kept.reshape(n, size).sum(1)
    packed = ids[kept].astype("<u4").tobytes()
    ends = (np.cumsum(counts) * 4).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends)]


def merge_alone(vocabulary: Vocabulary, token: bytes) -> bytes:
    """Ids of one long pre-token; its tree is a plain list."""
    n = len(token)
    size = 1 << (n - 1).bit_length()
    get, none = vocabulary.pairs.get, int(NONE)
    ids = vocabulary.single[np.frombuffer(token, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [(none, 0)] * (2 * size)

    def pair_at(at):
        right = after[at]
        return (none, 0) if right >= n else (get(ids[at] << 32 | ids[right], none), at)

    for at in range(n - 1):
        tree[size + at] = pair_at(at)
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(at, value):
        node = at + size
        tree[node] = value
        node >>= 1
        while node:
            best = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
            node >>= 1

    while tree[1][0] < none:
        rank, at = tree[1]
        gone = after[at]
        ids[at], ids[gone] = rank, -1
        after[at] = after[gone]
        if after[at] < n:
            before[after[at]] = at
        put(gone, (none, 0))
        put(at, pair_at(at))
        if before[at] >= 0:
            put(before[at], pair_at(before[at]))
    return np.array([i for i in ids if i >= 0], "<u4").tobytes()


def merge_all(vocabulary: Vocabulary, tokens: list[bytes]) -> dict[bytes, bytes]:
    """Ids of distinct pre-tokens."""
    found, by_size = {}, {}
    for token in tokens:
        rank = vocabulary.ranks.get(token)
        if rank is not None:
            found[token] = rank.to_bytes(4, "little")
        elif len(token) > SHORT:
            found[token] = merge_alone(vocabulary, token)
        else:
            by_size.setdefault(max(2, 1 << (len(token) - 1).bit_length()), []).append(token)
    for size, group in by_size.items():
        for start in range(0, len(group), TOGETHER):
            part = group[start:start + TOGETHER]
            found.update(zip(part, merge_together(vocabulary, part, size)))
    return found


class Encoder:
    """Encodes texts by pieces between single spaces, which no pre-token crosses; the pieces' ids are cached."""

    def __init__(self, vocabulary: Vocabulary, cached: int = CACHED):
        self.vocabulary, self.cached = vocabulary, cached
        self.tokens = regex.compile(vocabulary.pattern)
        # A space that is followed by no white space starts a pre-token.
        self.cut = regex.compile(r" (?=\S)")
        self.white = frozenset(regex.findall(r"\s", "".join(map(chr, range(0x3001)))))
        #: Ids of words with a space before them.
        self.known: dict[str, bytes] = {}

    def pre_tokens(self, piece: str) -> list[bytes]:
        if piece.isascii() and piece[1:].isalpha() and piece[0] == " ":
            return [piece.encode()]
        return [t.encode() for t in self.tokens.findall(piece)]

    def ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        parts = [self.pre_tokens(piece) for piece in pieces]
        found = merge_all(self.vocabulary, list(set(chain.from_iterable(parts))))
        return [found[p[0]] if len(p) == 1 else b"".join([found[t] for t in p]) for p in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [text.split(" ") for text in texts]
        words = set().union(*(c[1:] for c in cut))
        odd = {w for w in words if w not in self.known and (not w or w[0] in self.white)}
        if odd:
            cut = [c if odd.isdisjoint(c[1:]) else self.cut.split(text) for c, text in zip(cut, texts)]
            words = set().union(*(c[1:] for c in cut))
        missing = {w for w in words if w not in self.known}
        if len(self.known) + len(missing) > self.cached:
            self.known = {w: self.known[w] for w in words - missing}
        fresh, starts = list(missing), list({c[0] for c in cut})
        found = self.ids([*[" " + w for w in fresh], *starts])
        self.known.update(zip(fresh, found))
        first, get = dict(zip(starts, found[len(fresh):])), self.known.__getitem__
        return [first[c[0]] + b"".join(map(get, c[1:])) for c in cut]


def slices(texts: list, size: int = SLICE) -> Iterator[slice]:
    """Slices of a list of texts with about so many characters each."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def encode(docs: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Token ids of every text: id, n_tokens, ids (little-endian unsigned 32-bit integers).

    One row per input row, repeated rows and null ids included. Null and empty texts have no tokens. Special
    tokens are ordinary text. Other columns are left out. A text needs memory for itself, its pieces and its ids.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder = shared.value.encoder()
        for batch in batches:
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for part in slices(texts):
                ids = encoder.encode(texts[part])
                yield pa.RecordBatch.from_arrays(
                    [keys[part], pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["key", "n_tokens", "ids"])

    rows = docs.select(F.col(id_column).alias("key"), F.col(text_column).cast("string").alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()
    coded = rows.mapInArrow(handed_back(run), f"key {key_type}, n_tokens long, ids binary")
    return coded.select(F.col("key").alias(id_column), "n_tokens", "ids")


def decode(coded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds text_bytes, the bytes of the tokens in the column ids; null ids give no bytes.

    Unknown ids raise. The bytes of ids from encode() are those of the text.
    """
    spark = coded.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary.pieces)

    def run(batches):
        get = shared.value.__getitem__
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            found = [b"".join(map(get, np.frombuffer(i or b"", "<u4").tolist())) for i in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())],
                                             names=[*batch.schema.names, "text_bytes"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)
    return coded.mapInArrow(handed_back(run), f"{fields}, text_bytes binary")


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Encodes and decodes: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    back = decode(encode(docs.select("doc_id", text_bytes("text").cast("string").alias("text")), vocabulary), vocabulary)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("text_bytes", 256).alias("decoded_sha256"))
