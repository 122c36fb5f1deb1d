"""Alignment of two tokenisers, by an associative monoid of fragments.

Both tokenise the same bytes. Offsets where tokens of both end cut them into groups; an A token and a B token are linked
where their ranges overlap. A byte range of a text gives a fragment: the tokens that end before its first cut (open
prefix), the groups between its cuts (closed: only their text, their links and counts are kept), and the tokens after its
last cut (open suffix). Fragments of neighbouring ranges compose, in any bracketing: suffix and prefix become a group. So
long documents are cut into parts that Spark spreads over tasks, and their fragments meet in a tree reduction.

How many documents link two ids is counted over the whole corpus: homes, which are runs of some MB of documents in one
task, tell each pair once with its number of documents, get the pairs' totals back, and sum them over their documents.
"""

import hashlib
import json
import pickle
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermalis.llm.common import bounded_batches, settle
from thermalis.llm.word_bpe import byte_alphabet

#: Bytes of a text that one task tokenises; longer texts are cut where both tokenisers always end a token.
PART = 1 << 16
#: Bytes of a range that becomes a fragment.
RANGE = 1 << 14
#: Fragments that a step of the reduction composes.
FAN = 16
#: Bytes of texts that are aligned together, and of a home.
SLICE, HOME = 1 << 20, 32 << 20
SPACE = "▁"


class Tokenisers:
    """A: byte-level BPE from a file of the tokenizers library; B: a sentencepiece model. Some MB that travel with a task.

    A is run by tiktoken, from the ids and pattern of the file; merges must have the order of their ids.
    """

    def __init__(self, byte_json: str, piece_model: bytes, pattern: str):
        self.sources = byte_json, piece_model, pattern
        self._ready = False

    @classmethod
    def read(cls, byte_path: str, piece_path: str, pattern: str) -> "Tokenisers":
        with open(byte_path, encoding="utf-8") as a, open(piece_path, "rb") as b:
            return cls(a.read(), b.read(), pattern)

    def __getstate__(self):
        return self.sources

    def __setstate__(self, sources):
        self.__init__(*sources)

    def ready(self) -> "Tokenisers":
        """Loaded, once in a process."""
        if self._ready:
            return self
        byte_json, piece_model, pattern = self.sources
        told, alphabet = json.loads(byte_json), byte_alphabet()
        ids = told["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        if [ids[a + b] for a, b in merges] != list(range(256, 256 + len(merges))) or told["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("merges must have the order of their ids, and no space may be added")
        raw = {bytes(alphabet[c] for c in token): i for token, i in ids.items()}
        self.a_bytes = [b""] * (max(raw.values()) + 1)
        for token, i in raw.items():
            self.a_bytes[i] = token
        self.encode_a = tiktoken.Encoding("A", pat_str=pattern, mergeable_ranks=raw, special_tokens={}).encode_ordinary
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := re.fullmatch("<0x(..)>", p)) else p.replace(SPACE, " ").encode() for p in pieces]
        #: No piece goes on with a space after anything else, so a space after another character starts a token of both.
        self.can_cut = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.a_len, self.b_len = (np.array([len(t) for t in own], np.int64) for own in (self.a_bytes, self.b_bytes))
        self.n_b = len(pieces)
        #: Ids as they stand in the text of a group: followed by another of their kind, or by the end of these.
        self.written = [s.encode() for n, ends in ((len(self.a_bytes), ",|"), (self.n_b, ",;")) for i in range(n) for s in (f"{i}{ends[0]}", f"{i}{ends[1]}")]
        self._ready = True
        return self

    def tokens(self, texts: list[str]) -> Iterator[tuple[list[int], list[int], int] | None]:
        """Ids of A and B and the bytes of a space and each text; None if either's bytes differ from these."""
        for text, b in zip(texts, self.b.encode(texts, num_threads=1) if texts else []):
            whole = (" " + text).encode()
            a = self.encode_a(" " + text)
            same = b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b))
            yield (a, b, len(whole)) if text and same else None


def no_ids() -> np.ndarray:
    return np.empty(0, np.int64)


@dataclass
class Open:
    """Tokens of A and B with their ends in the text."""

    a: np.ndarray = field(default_factory=no_ids)
    a_ends: np.ndarray = field(default_factory=no_ids)
    b: np.ndarray = field(default_factory=no_ids)
    b_ends: np.ndarray = field(default_factory=no_ids)

    def __add__(self, other: "Open") -> "Open":
        return Open(*(np.concatenate((getattr(self, c), getattr(other, c))) for c in ("a", "a_ends", "b", "b_ends")))

    def __len__(self):
        return len(self.a) + len(self.b)


@dataclass
class Fragment:
    """What a byte range tells. pairs are a * n_b + b, sorted, linked times often; text has a ";" after each closed group.

    cut: whether both end anywhere in the range or at its start. ok: whether the bytes of both are those of the text.
    """

    ok: bool = True
    cut: bool = False
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    text: bytes = b""
    pairs: np.ndarray = field(default_factory=no_ids)
    times: np.ndarray = field(default_factory=no_ids)
    prefix: Open = field(default_factory=Open)
    suffix: Open = field(default_factory=Open)


def tallied(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their weights."""
    found, where = np.unique(np.concatenate([no_ids(), *keys]), return_inverse=True)
    return found, np.bincount(where, np.concatenate([no_ids(), *weights]), len(found)).astype(np.int64)


def fragments(tok: Tokenisers, stream: Open, bounds: np.ndarray, base: int = 0) -> list[Fragment]:
    """The fragments of the ranges that end at bounds, of a stream that starts with a cut at offset base."""
    a, a_ends, b, b_ends = stream.a, stream.a_ends, stream.b, stream.b_ends
    cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
    starts = np.concatenate(([base], bounds[:-1]))
    lo, hi = np.searchsorted(cuts, starts, "right"), np.searchsorted(cuts, bounds, "right")
    fresh = (starts == base) | ((lo > 0) & (np.concatenate(([-1], cuts))[lo] == starts))
    # Each interval between two neighbouring ends is the overlap of one A and one B token.
    ends = np.union1d(a_ends, b_ends)
    inside = ends <= min(a_ends[-1], b_ends[-1]) if len(a) and len(b) else np.zeros(len(ends), bool)
    ends = ends[inside]
    pair = a[np.searchsorted(a_ends, ends)] * tok.n_b + b[np.searchsorted(b_ends, ends)] if len(ends) else no_ids()
    # The text: in each group the A tokens, then the B tokens.
    group_a, group_b = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
    a_upto, b_upto = (np.concatenate(([0], np.searchsorted(own, cuts, "right"), [len(own)])) for own in (a_ends, b_ends))
    code = np.empty(len(a) + len(b), np.int64)
    code[np.arange(len(a)) + b_upto[group_a]] = 2 * a + np.append(group_a[1:] != group_a[:-1], True)[:len(a)]
    code[np.arange(len(b)) + a_upto[group_b + 1]] = 2 * (b + len(tok.a_bytes)) + np.append(group_b[1:] != group_b[:-1], True)[:len(b)]
    code = code.tolist()
    out = []
    at_a, at_b = np.searchsorted(a_ends, starts, "right"), np.searchsorted(b_ends, starts, "right")
    to_a, to_b = np.searchsorted(a_ends, bounds, "right"), np.searchsorted(b_ends, bounds, "right")
    for i in range(len(bounds)):
        if not fresh[i] and lo[i] == hi[i]:
            out.append(Fragment(n_a=to_a[i] - at_a[i], n_b=to_b[i] - at_b[i], prefix=Open(
                a[at_a[i]:to_a[i]], a_ends[at_a[i]:to_a[i]], b[at_b[i]:to_b[i]], b_ends[at_b[i]:to_b[i]])))
            continue
        first = lo[i] if fresh[i] else lo[i] + 1  # closed groups are first to hi - 1
        a0, a1, b0, b1 = a_upto[first], a_upto[hi[i]], b_upto[first], b_upto[hi[i]]
        low, high = (cuts[first - 1] if first else base), (cuts[hi[i] - 1] if hi[i] else base)
        links = pair[np.searchsorted(ends, low, "right"):np.searchsorted(ends, high, "right")]
        pairs, times = np.unique(links, return_counts=True)
        out.append(Fragment(
            True, True, to_a[i] - at_a[i], to_b[i] - at_b[i], hi[i] - first, b"".join(map(tok.written.__getitem__, code[a0 + b0:a1 + b1])), pairs, times,
            Open(a[at_a[i]:a0], a_ends[at_a[i]:a0], b[at_b[i]:b0], b_ends[at_b[i]:b0]),
            Open(a[a1:to_a[i]], a_ends[a1:to_a[i]], b[b1:to_b[i]], b_ends[b1:to_b[i]])))
    return out


def composed(tok: Tokenisers, left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative."""
    ok, n_a, n_b = left.ok and right.ok, left.n_a + right.n_a, left.n_b + right.n_b
    if not right.cut:
        if not left.cut:
            return Fragment(ok, False, n_a, n_b, prefix=left.prefix + right.prefix)
        return Fragment(ok, True, n_a, n_b, left.n_groups, left.text, left.pairs, left.times, left.prefix, left.suffix + right.prefix)
    if not left.cut:
        return Fragment(ok, True, n_a, n_b, right.n_groups, right.text, right.pairs, right.times, left.prefix + right.prefix, right.suffix)
    middle, between = left.suffix + right.prefix, Fragment()
    if len(middle):
        between = one_group(tok, middle)
    pairs, times = tallied([left.pairs, between.pairs, right.pairs], [left.times, between.times, right.times])
    return Fragment(ok, True, n_a, n_b, left.n_groups + between.n_groups + right.n_groups, left.text + between.text + right.text,
                    pairs, times, left.prefix, right.suffix)


def one_group(tok: Tokenisers, tokens: Open) -> Fragment:
    """The closed group of tokens that have one common end, the last."""
    end = int(tokens.a_ends[-1])
    return fragments(tok, tokens, np.array([end]), base=-1)[0]


def tree(tok: Tokenisers, parts: list[Fragment]) -> Fragment:
    """All fragments of a text in their order, composed two by two."""
    while len(parts) > 1:
        parts = [reduce(lambda x, y: composed(tok, x, y), parts[i:i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def aligned(tok: Tokenisers, texts: list[str], size: int, bases: list[int] | None = None) -> list[list[Fragment]]:
    """The fragments of each text's ranges of so many bytes; texts are aligned side by side.

    A text starts with a space that is not part of it, and with a cut. Offsets go on from bases, 0 by default.
    """
    found = list(tok.tokens(texts))
    good = [f for f in found if f]
    if not good:
        return [[Fragment(ok=False, cut=True)] for _ in texts]
    a, b = (np.concatenate([np.array(f[k], np.int64) for f in good]) for k in (0, 1))
    lengths = np.array([f[2] for f in good])
    to = np.cumsum(lengths)
    bounds = np.concatenate([np.minimum(np.arange(size, n + size, size), n) + end - n for n, end in zip(lengths, to)])
    whole = iter(fragments(tok, Open(a, np.cumsum(tok.a_len[a]), b, np.cumsum(tok.b_len[b])), bounds))
    out, start = [], 0
    for i, f in enumerate(found):
        if not f:
            out.append([Fragment(ok=False, cut=True)])
            continue
        own = [next(whole) for _ in range(-(-f[2] // size))]
        shift = (bases[i] if bases else 0) - start
        for part in own:
            for tokens in (part.prefix, part.suffix):
                tokens.a_ends, tokens.b_ends = tokens.a_ends + shift, tokens.b_ends + shift
        out.append(own)
        start += f[2]
    return out


def squeezed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    return zstandard.compress(np.diff(pairs, prepend=0).astype("<u8" if len(pairs) and pairs[-1] >> 32 else "<u4").tobytes()
                              + times.astype("<u4").tobytes() + bytes([bool(len(pairs) and pairs[-1] >> 32)]), 3)


def stretched(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(packed)
    width = 8 if raw[-1] else 4
    n = (len(raw) - 1) // (width + 4)
    return (np.cumsum(np.frombuffer(raw, f"<u{width}", n).astype(np.int64)), np.frombuffer(raw, "<u4", n, width * n).astype(np.int64))


RESULT = pa.schema([("home", pa.int64()), ("is_home", pa.bool_()), ("doc", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary())])
RESULT_DDL = ("home long, is_home boolean, doc long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "links binary")


def row_of(home: int, doc: int | None, f: Fragment) -> tuple:
    """A document's row of the table of results, from the fragment of its whole text."""
    if not f.ok or not f.n_a:
        return home, False, doc, 0, 0, 0, 0, "", squeezed(no_ids(), no_ids())
    if len(f.prefix) or len(f.suffix) or not f.cut:
        raise ValueError("a whole text has no open tokens")
    return (home, False, doc, int(f.n_a), int(f.n_b), int(f.n_groups), int(f.times.sum()), hashlib.sha256(f.text[:-1]).hexdigest(), squeezed(f.pairs, f.times))


class Home:
    """Counts in how many documents of a home each pair is linked. Its number is drawn once, as rows are written once."""

    def __init__(self):
        self.number, self.size, self.waiting = uuid.uuid4().int >> 65, 0, 0
        self.keys, self.counts = [], []

    def add(self, f: Fragment, size: int) -> None:
        self.size += size
        if f.ok:
            self.keys.append(f.pairs)
            self.counts.append(np.ones(len(f.pairs), np.int64))
            self.waiting += len(f.pairs)
            if self.waiting > 1 << 20:
                keys, counts = tallied(self.keys, self.counts)
                self.keys, self.counts, self.waiting = [keys], [counts], 0

    def row(self) -> tuple:
        return self.number, True, None, 0, 0, 0, 0, "", squeezed(*tallied(self.keys, self.counts))


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def cut_texts(text: str, size: int) -> Iterator[tuple[int, str]]:
    """Parts of a text with the offsets in bytes of the spaces that they follow; that before the text counts.

    A part ends before a single space between other characters, which the next part leaves out; it is longer than size
    only where there is none.
    """
    cut, start, offset = re.compile(rf"(?<=[^\s{SPACE}]) (?=[^\s{SPACE}])"), 0, 0
    while len(text) - start > size and (found := cut.search(text, start + size)):
        part = text[start:found.start()]
        yield offset, part
        start, offset = found.end(), offset + 1 + len(part.encode())
    yield offset, text[start:]


def short_results(rows: DataFrame, shared) -> DataFrame:
    """Results of documents that one task tokenises whole. rows: doc, text."""
    def run(batches):
        tok, home, out = shared.value.ready(), Home(), []
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            start = held = 0
            for i, text in enumerate(texts):
                held += len(text)
                if held >= SLICE or i + 1 == len(texts):
                    for doc, own, parts in zip(docs[start:i + 1], texts[start:i + 1], aligned(tok, texts[start:i + 1], RANGE)):
                        whole = tree(tok, parts)
                        home.add(whole, len(own))
                        out.append(row_of(home.number, doc, whole))
                    yield as_batch(out, RESULT)
                    start, held, out = i + 1, 0, []
            if home.size >= HOME:
                yield as_batch([home.row()], RESULT)
                home = Home()
        yield as_batch([home.row()], RESULT)

    return rows.mapInArrow(run, RESULT_DDL)


def long_results(rows: DataFrame, shared, part_bytes: int) -> DataFrame | None:
    """Results of long documents, by a tree reduction over Spark tasks; None if there are none."""
    def cut(batches):
        tok = shared.value.ready()
        for batch in batches:
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                parts = cut_texts(text, part_bytes) if tok.can_cut else [(0, text)]
                for k, (offset, part) in enumerate(parts):
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([doc], pa.int64()), pa.array([k], pa.int64()),
                                                      pa.array([offset], pa.int64()), pa.array([part], pa.string())], names=["row", "doc", "part", "base", "text"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc", "text")
    parts = settle(numbered.mapInArrow(cut, "row long, doc long, part long, base long, text string"), "alignment-parts")
    last = parts.agg(F.max("part")).first()[0]
    if last is None:
        return None
    spark = rows.sparkSession
    kinds = pa.schema([("row", pa.int64()), ("doc", pa.int64()), ("part", pa.int64()), ("place", pa.int64()), ("fragment", pa.binary())])
    ddl = "row long, doc long, part long, place long, fragment binary"

    def ranges(batches):
        tok, squeeze = shared.value.ready(), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for row, doc, part, base, text in zip(*(c.to_pylist() for c in batch.columns)):
                own, = aligned(tok, [text], RANGE, [base])
                yield as_batch([(row, doc, part, i, squeeze(pickle.dumps(f, 5))) for i, f in enumerate(own)], kinds)

    def compose(key, table):
        tok, stretch = shared.value.ready(), zstandard.ZstdDecompressor().decompress
        order = table.sort_by([("part", "ascending"), ("place", "ascending")])
        whole = tree(tok, [pickle.loads(stretch(raw)) for raw in order.column("fragment").to_pylist()])
        row, part = (k.as_py() for k in key)
        return pa.table([[row], [table.column("doc")[0].as_py()], [part], [0], [zstandard.compress(pickle.dumps(whole, 5), 3)]], schema=kinds)

    spread = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "row", "part")
    now = spread.mapInArrow(ranges, ddl)
    # Ranges of a part first, then FAN parts at a time.
    now = settle(now.groupBy("row", "part").applyInArrow(compose, ddl), "alignment-fragments")
    while last:
        now = settle(now.groupBy("row", F.floor(F.col("part") / FAN)).applyInArrow(compose, ddl), "alignment-fragments")
        last //= FAN

    def finished(batches):
        stretch = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for doc, raw in zip(*(c.to_pylist() for c in batch.columns)):
                whole, home = pickle.loads(stretch(raw)), Home()
                home.add(whole, 0)
                yield as_batch([row_of(home.number, doc, whole), home.row()], RESULT)

    return now.select("doc", "fragment").mapInArrow(finished, RESULT_DDL)


def alignments(docs: DataFrame, tokenisers: Tokenisers, id_column: str = "doc_id", text_column: str = "text", part_bytes: int = PART) -> DataFrame:
    """doc, n_a, n_b, n_groups, n_links, groups_sha256, links (see stretched), home, and a row per home (is_home), settled."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(tokenisers)
    rows = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text") > part_bytes, F.lit(False))
    short = settle(short_results(rows.where(~is_long), shared), "alignments")
    long = long_results(rows.where(is_long), shared, part_bytes)
    return short if long is None else short.unionByName(settle(long, "alignments"))


def pair_counts(results: DataFrame) -> DataFrame:
    """home, pair, n: in how many documents of each home a pair is linked."""
    def run(batches):
        for batch in batches:
            for home, packed in zip(*(c.to_pylist() for c in batch.columns)):
                pairs, n = stretched(packed)
                for i in range(0, len(pairs), 1 << 16):
                    some = slice(i, i + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs[some]), home)), pa.array(pairs[some]), pa.array(n[some])],
                                                     names=["home", "pair", "n"])

    return results.where("is_home").select("home", "links").mapInArrow(run, "home long, pair long, n long")


def align(docs: DataFrame, tokenisers: Tokenisers, id_column: str = "doc_id", text_column: str = "text", part_bytes: int = PART) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: a row per input row.

    Both tokenisers see a space and the text. Null and empty texts, and texts whose bytes either does not give back, have
    no tokens: zeros, and "" as groups_sha256. A pair's count is the number of rows that hold it linked. n_best are the
    links whose count is the highest of their A id, count_sum is the sum of the links' counts. groups_sha256 is of the
    groups as `a1,a2|b1;a3|b2,b3`. Repeated rows and null ids are rows like others; other columns are left out.
    """
    n_b = sentencepiece.SentencePieceProcessor(model_proto=tokenisers.sources[1]).get_piece_size()
    results = alignments(docs, tokenisers, id_column, text_column, part_bytes)
    at_homes = pair_counts(results)
    counts = settle(at_homes.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-counts")
    a = F.floor(F.col("pair") / n_b)
    # At most one row for each id of A's vocabulary.
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))
    judged = counts.join(F.broadcast(highest), a == F.col("a")).select("pair", F.when(F.col("n") == F.col("top"), F.col("n")).otherwise(-F.col("n")).alias("n"))
    answers = at_homes.select("home", "pair").join(judged, "pair").select("home", "pair", "n")
    own = results.where("NOT is_home")
    schema = pa.schema([(c, pa.int64()) for c in ("doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())])

    def summed(rows, answers):
        known, n = answers.column("pair").to_numpy(), answers.column("n").to_numpy()
        order = np.argsort(known)
        known, n = known[order], n[order]
        best, sums = [], []
        for packed in rows.column("links"):
            pairs, times = stretched(packed.as_py())
            # A negative count is not the highest of its A id.
            found = n[np.searchsorted(known, pairs)] if len(pairs) else no_ids()
            best.append(int(times[found > 0].sum()))
            sums.append(int((times * np.abs(found)).sum()))
        more = {"n_best": pa.array(best, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
        return pa.table([more[c] if c in more else rows.column(c) for c in schema.names], schema=schema)

    ddl = "doc long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    found = own.groupBy("home").cogroup(answers.groupBy("home")).applyInArrow(summed, ddl)
    return found.withColumnRenamed("doc", id_column)
