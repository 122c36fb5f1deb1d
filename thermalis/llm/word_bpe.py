"""BPE with word ends: a streaming transducer with bounded lookahead, and an incremental decoder.

A merge list has a sufficient lookahead. Cut a word after some symbols and merge only those: whatever follows can
change the result only near the cut. At the cut one rule may join a token x with what follows; that takes x from its left neighbour,
or gives it to it, by a later rule whose right part starts with x; and so on. The longest such chain of rules, measured
in the symbols of their left parts, is the lookahead (`lookahead`; 721 symbols for the vocabulary that the query uses).
Tokens that end further from the cut are stable. The transducer merges a window, emits its stable tokens and keeps the
rest, so its memory does not grow with the word. Words are told apart by the vocabulary's own normaliser and
pre-tokeniser, a slice of the text at a time; slices end where neither looks across.

Words are encoded once while they stay in a cache of bounded size. Words are bytes here.
"""

import codecs
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from thermalis.llm.common import bounded_batches

#: Mark of a word's last symbol, as the vocabulary files write it.
END = "</w>"
#: Symbols beyond the lookahead that are merged together.
WINDOW = 4096
#: Words of more symbols are merged through a heap.
SHORT = 48
#: Characters of a slice of text without spaces.
SLICE = 1 << 15
#: Cached words, and cached texts between spaces, per worker; of about 200 bytes each. Longer ones than KNOWN are not kept.
CACHED, KNOWN = 300_000, 64
WHITE = " \t\n\r\f\v"
#: Texts of characters before this one are composed already, and Python's lower case and classes are those of the library.
PLAIN = "\u0250"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: printable Latin-1 for itself, the others from U+0100 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def lookahead(merges: list[tuple[str, str]]) -> int:
    """How many symbols before a cut the symbols after it can change tokens at most; the rules in their order."""
    reach: dict[str, int] = {}
    longest = 0
    for left, right in merges:
        marked = right.endswith(END)
        n = len(right) - len(END) - 1 if marked else len(right)
        chain = len(left) + max((reach.get(right[:k], 0) for k in range(1, n + 1)), default=0)
        reach[left] = max(chain, reach.get(left, 0))
        longest = max(longest, chain)
    return longest


class WordModel:
    """A vocabulary file of the tokenizers library, read once; small enough to travel with a task (some MB)."""

    def __init__(self, source: str):
        self.source = source
        self.load()

    @classmethod
    def read(cls, path: str) -> "WordModel":
        with open(path, encoding="utf-8") as file:
            return cls(file.read())

    def load(self) -> None:
        told = json.loads(self.source)
        model, ids = told["model"], told["model"]["vocab"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or model["continuing_subword_prefix"] or model["unk_token"]:
            raise ValueError("not a BPE vocabulary with word ends alone")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = {}
        self.ranks, self.made = {}, []
        for rank, (left, right) in enumerate(merges):
            if made.setdefault(left + right, rank) != rank or any(made.get(part, -1) >= rank for part in (left, right)):
                raise ValueError("rules must make each token once, from tokens of earlier rules")
            self.ranks[ids[left] << 32 | ids[right]] = rank
            self.made.append(ids[left + right])
        self.lookahead, self.none, self.alphabet = lookahead(merges), len(merges), byte_alphabet()
        self.inner, self.last = ([i for _, i in sorted((b, ids[c + mark]) for c, b in self.alphabet.items())] for mark in ("", END))
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.pieces = {i: piece for piece, i in ids.items()} | {i: piece for piece, i in self.special.items()}
        library = Tokenizer.from_str(self.source)
        self.normalise, self.pre_tokenise = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        splitter = next(p for p in told["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(splitter["pattern"]["Regex"])
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def __getstate__(self):
        return self.source

    def __setstate__(self, source):
        self.__init__(source)

    def words(self, text: str) -> list[bytes]:
        """The words of a text: normalised and split as the vocabulary says."""
        if text and max(text) < PLAIN:
            return [word.encode() for word in self.pattern.findall(text.lower())]
        return [bytes(map(self.alphabet.__getitem__, word)) for word, _ in self.pre_tokenise(self.normalise(text))]

    def symbols(self, word: bytes) -> list[int]:
        ids = [self.inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        return ids

    def merged(self, ids: list[int]) -> list[int]:
        """The tokens of symbols: always the earliest rule that fits, leftmost first."""
        if len(ids) > SHORT:
            return self.merged_long(ids)
        get, made, none = self.ranks.get, self.made, self.none
        ranks = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) < none:
            at, token = ranks.index(rank), made[rank]
            ids[at] = token
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = get(ids[at - 1] << 32 | token, none)
            if at < len(ranks):
                ranks[at] = get(token << 32 | ids[at + 1], none)
        return ids

    def merged_long(self, ids: list[int]) -> list[int]:
        n, ids, get = len(ids), list(ids), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, at) for at, (a, b) in enumerate(zip(ids, ids[1:])) if (rank := get(a << 32 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            right = after[at]
            if right >= n or ids[at] < 0 or get(ids[at] << 32 | ids[right]) != rank:
                continue
            ids[at], ids[right] = self.made[rank], -1
            after[at] = follower = after[right]
            if follower < n:
                before[follower] = at
                if (rank := get(ids[at] << 32 | ids[follower])) is not None:
                    heapq.heappush(heap, (rank, at))
            if (left := before[at]) >= 0 and (rank := get(ids[left] << 32 | ids[at])) is not None:
                heapq.heappush(heap, (rank, left))
        return [i for i in ids if i >= 0]


class Transducer:
    """Encodes one word after the other from bytes that arrive in parts; holds a window and the lookahead at most."""

    def __init__(self, model: WordModel, window: int = WINDOW):
        self.model, self.window, self.held = model, window, b""
        self.length = {i: len(piece.removesuffix(END)) for i, piece in model.pieces.items()}

    def feed(self, part: bytes) -> Iterator[int]:
        """The tokens that are stable, given more bytes of the word."""
        inner, ahead = self.model.inner, self.model.lookahead
        for start in range(0, len(part), self.window):
            self.held += part[start:start + self.window]
            if len(self.held) > self.window + ahead:
                # The last byte may be the word's last, which is another symbol.
                cut, end = len(self.held) - 1, 0
                for token in self.model.merged([inner[b] for b in self.held[:cut]]):
                    if end + self.length[token] > cut - ahead:
                        break
                    end += self.length[token]
                    yield token
                self.held = self.held[end:]

    def finish(self) -> list[int]:
        """The rest of the word's tokens; the next bytes are those of another word."""
        held, self.held = self.held, b""
        return self.model.merged(self.model.symbols(held)) if held else []


def is_letter(c: str) -> bool:
    return unicodedata.category(c)[0] == "L" and len(c.lower()) == 1


def cut_between(before: str, c: str) -> bool | None:
    """Whether a word goes on across a cut of a text between before and c; None if it cannot be cut there.

    Normalisation must not look across: c is ASCII or a letter that joins with nothing before it. The word pattern must
    see the same words: apostrophes, which start words of their own, stay away from cuts inside words.
    """
    last = before[-1]
    if c in WHITE or last in WHITE:
        return False if c.isascii() else None
    if c.isascii() and c.isdigit():
        return False
    if is_letter(last):
        if c.isascii() and not c.isalnum():
            return False
        conjoining = "ᅠ" <= c <= "ᇿ" or "ힰ" <= c <= "퟿"
        return True if is_letter(c) and not conjoining and "'" not in before[-4:] else None
    both = last + c
    return True if both.isascii() and not any(x.isalnum() or x == "'" or x < " " for x in both) else None


def slices(text: str, size: int = SLICE) -> Iterator[tuple[str, bool]]:
    """Slices of a text and whether a word goes on after each; longer than size only where it cannot be cut."""
    start = 0
    while len(text) - start > size:
        at = start + size
        while at < len(text) and (goes_on := cut_between(text[max(at - 4, start):at], text[at])) is None:
            at += 1
        if at >= len(text):
            break
        yield text[start:at], goes_on
        start = at
    yield text[start:], False


class Encoder:
    """Encodes texts; the ids of words, and of what stands between single spaces, are cached, as little-endian 32-bit
    integers."""

    def __init__(self, model: WordModel, cached: int = CACHED, window: int = WINDOW, size: int = SLICE):
        self.model, self.cached, self.size = model, cached, size
        self.transducer, self.known, self.known_words = Transducer(model, window), {}, {}

    def stream(self, text: str) -> Iterator[int]:
        """Token ids of a text without special tokens, as they become stable."""
        inside = False
        for part, goes_on in slices(text, self.size):
            words = self.model.words(part)
            for i, word in enumerate(words):
                if i or not inside:
                    yield from self.transducer.finish()
                yield from self.transducer.feed(word)
            inside = goes_on and bool(words)
            if not goes_on:
                yield from self.transducer.finish()
        yield from self.transducer.finish()

    def word(self, word: bytes) -> bytes:
        found = self.known_words.get(word)
        if found is None:
            if len(word) > KNOWN:
                return np.fromiter((*self.transducer.feed(word), *self.transducer.finish()), "<u4").tobytes()
            ids = self.model.merged(self.model.symbols(word))
            found = self.known_words[word] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def piece(self, piece: str) -> bytes:
        if len(piece) > self.size:
            return np.fromiter(self.stream(piece), "<u4").tobytes()
        return b"".join(map(self.word, self.model.words(piece)))

    def plain(self, text: str) -> bytes:
        pieces, known, rare = text.split(" "), self.known, {}
        for piece in {p for p in pieces if p not in known}:
            (known if len(piece) <= KNOWN else rare)[piece] = self.piece(piece)
        out = b"".join([known[p] if p in known else rare[p] for p in pieces])
        for cache in (known, self.known_words):
            if len(cache) > self.cached:
                cache.clear()
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text; special tokens in it are found before anything else, as written."""
        parts = self.model.specials.split(text) if self.model.special else [text]
        return b"".join(self.model.special[p].to_bytes(4, "little") if i % 2 else self.plain(p) for i, p in enumerate(parts))


class Detokeniser:
    """Text from ids that arrive in parts. State: the bytes, three at most, of a character that is not complete."""

    def __init__(self, model: WordModel):
        alphabet = model.alphabet
        self.special = {i: text for text, i in model.special.items()}
        self.raw = {i: (bytes(alphabet[c] for c in piece.removesuffix(END)), piece.endswith(END))
                    for i, piece in model.pieces.items() if i not in self.special}
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        out = []
        for i in ids:
            if i in self.special:
                out += [self.state.decode(b"", True), self.special[i]]
                self.state.reset()
                continue
            raw, ends = self.raw[i]
            out.append(self.state.decode(raw, ends))
            if ends:
                self.state.reset()
                out.append(" ")
        return "".join(out)

    def finish(self) -> str:
        rest = self.state.decode(b"", True)
        self.state.reset()
        return rest


_encoders: dict[int, Encoder] = {}


def encode(docs: DataFrame, model: WordModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Token ids of every whole text: id, n_tokens, ids (array of int).

    One row per input row, repeated rows and null ids included. Null and empty texts have no tokens. Special tokens in a
    text are special. Other columns are left out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        # One encoder for all tasks of a worker process.
        encoder = _encoders.get(id(shared.value)) or _encoders.setdefault(id(shared.value), Encoder(shared.value))
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            start, held, size = 0, [], 0
            for i in range(len(keys)):
                held.append(np.frombuffer(encoder.encode(texts[i].as_py() or ""), "<i4"))
                size += len(held[-1])
                if size >= 1 << 20 or i + 1 == len(keys):
                    ends = np.cumsum([0, *map(len, held)]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held)))
                    yield pa.RecordBatch.from_arrays([keys[start:i + 1], pa.array(np.diff(ends), pa.int64()), ids],
                                                     names=["key", "n_tokens", "ids"])
                    start, held, size = i + 1, [], 0

    rows = docs.select(F.col(id_column).alias("key"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_tokens long, ids array<int>").select(F.col("key").alias(id_column), "n_tokens", "ids")


def decode(coded: DataFrame, model: WordModel, form: str = "tokens") -> DataFrame:
    """Adds decoded, from the column ids: the tokens joined by spaces, as the library's decode gives them for a vocabulary
    without a decoder (form tokens), or readable text, where words end with a space (form text). Null ids give "".
    Unknown ids raise.
    """
    spark = coded.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        pieces, machine = shared.value.pieces, Detokeniser(shared.value)
        for batch in batches:
            found = []
            for ids in batch.column(batch.schema.get_field_index("ids")):
                own = ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else []
                if form == "tokens":
                    found.append(" ".join(map(pieces.__getitem__, own)))
                else:
                    found.append("".join([*(machine.feed(own[i:i + WINDOW]) for i in range(0, len(own), WINDOW)), machine.finish()]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)
    return coded.mapInArrow(run, f"{fields}, decoded string")


def round_trip(docs: DataFrame, model: WordModel) -> DataFrame:
    """Encodes and decodes: doc_id, n_tokens, ids_sha256 (of decimal ids joined by spaces), decoded_sha256."""
    back = decode(encode(docs.select("doc_id", "text"), model), model)
    return back.select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
