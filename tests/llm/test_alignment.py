"""The alignment of two tokenisers against loops over tokens."""

import hashlib
import random
from collections import Counter
from functools import reduce

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from thermalis.llm import alignment
from thermalis.llm.registry import op11_fragment_alignment, tokenisers


@pytest.fixture(scope="module")
def tok():
    return tokenisers().ready()


def brute(rows):
    """What a row per document must hold, from the two libraries and plain loops."""
    a_lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    def b_bytes(piece):
        return bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") and piece.endswith(">") and len(piece) == 6 else piece.replace("▁", " ").encode()

    def spans(ids, raw):
        out, at = [], 0
        for i, r in zip(ids, raw):
            out.append((i, at, at + len(r)))
            at += len(r)
        return out

    docs, counts = [], Counter()
    for key, text in rows:
        whole = (" " + (text or "")).encode()
        ea = a_lib.encode(" " + (text or ""), add_special_tokens=False)
        eb = b_lib.encode(text or "")
        ra = [bytes(table[c] for c in t) for t in ea.tokens]
        rb = [b_bytes(b_lib.id_to_piece(i)) for i in eb]
        if not text or b"".join(ra) != whole or b"".join(rb) != whole:
            docs.append((key, [], [], []))
            continue
        sa, sb = spans(ea.ids, ra), spans(eb, rb)
        ends = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
        groups, start = [], 0
        for end in ends:
            groups.append(([x for x in sa if start <= x[1] and x[2] <= end], [x for x in sb if start <= x[1] and x[2] <= end]))
            start = end
        links = [(x[0], y[0]) for ga, gb in groups for x in ga for y in gb if x[1] < y[2] and y[1] < x[2]]
        counts.update(set(links))
        docs.append((key, sa, sb, (groups, links)))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(n, top.get(a, 0))
    out = []
    for key, sa, sb, more in docs:
        if not sa:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        groups, links = more
        text = ";".join(",".join(str(x[0]) for x in ga) + "|" + ",".join(str(x[0]) for x in gb) for ga, gb in groups)
        out.append((key, len(sa), len(sb), len(groups), len(links), sum(counts[k] == top[k[0]] for k in links),
                    sum(counts[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [" ", "  ", "\n", "\t", "a", "The", "ing", "tion", "'s", "É", "é", "ß", "1", "2024", "!", "...", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>",
       "日本", "🙂", "‍", "▁", "ﬁ", "\xa0", " the", " of", "    ", "\r\n", "\0", "ab" * 9, "====", " x", "ʼ"]


def odd_texts(seed, n, longest=60):
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD if i % 3 else [x for x in ODD if "▁" not in x], k=rng.randint(0, longest))) for i in range(n)]


def test_against_loops_with_short_and_long_documents(spark):
    rows = list(enumerate([*odd_texts(1, 120), *odd_texts(2, 20, 900), "", None, " ", "word", "x y", " " * 500]))
    rows += [(7, rows[7][1]), (None, "a null id"), (None, rows[125][1])]
    docs = spark.createDataFrame([(*r, "h", 3) for r in rows], "doc_id long, text string, home string, n_a int").repartition(4)
    want = brute(rows)
    for part in (60, 1 << 16):
        got = alignment.align(docs, tokenisers(), part_bytes=part).select(COLUMNS).collect()
        assert sorted(map(tuple, got), key=repr) == want
    assert alignment.align(docs.limit(0), tokenisers()).collect() == []


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op11_fragment_alignment(spark, sf).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def state(f):
    opened = [[x.tolist() for x in (t.a, t.a_ends, t.b, t.b_ends)] for t in (f.prefix, f.suffix)]
    return f.ok, f.cut, int(f.n_a), int(f.n_b), int(f.n_groups), f.text, f.pairs.tolist(), f.times.tolist(), opened


def test_fragments_compose_in_any_bracketing(tok):
    rng = random.Random(3)
    opened = 0
    for text in ["the quick brown fox, naïvely 日本語 🙂", *odd_texts(4, 60, 25)]:
        ((whole,),) = alignment.aligned(tok, [text], 1 << 20)
        for size in (1, 2, 3, 7, 20):
            own, = alignment.aligned(tok, [text], size)
            opened += sum(bool(len(f.prefix) or len(f.suffix)) for f in own)
            assert state(alignment.tree(tok, own)) == state(whole)
            left = reduce(lambda x, y: alignment.composed(tok, x, y), own)
            while len(own) > 1:
                at = rng.randrange(len(own) - 1)
                own[at:at + 2] = [alignment.composed(tok, own[at], own[at + 1])]
            assert state(own[0]) == state(left) == state(whole)
    assert opened > 100


def test_parts_are_cut_where_both_end_tokens(tok):
    for text in odd_texts(5, 60, 200):
        parts = list(alignment.cut_texts(text, 20))
        assert " ".join(p for _, p in parts) == text
        assert all((" " + text).encode()[offset:offset + 1] == b" " for offset, _ in parts)
        for k in (0, 1):
            ids = [tok.encode_a(" " + p) if k == 0 else tok.b.encode(p) for _, p in parts]
            assert sum(ids, []) == (tok.encode_a(" " + text) if k == 0 else tok.b.encode(text))


def test_packed_links():
    import numpy as np
    for pairs in ([], [0], [3, 9, 1 << 31], [5, 1 << 40]):
        got = alignment.stretched(alignment.squeezed(np.array(pairs, np.int64), np.arange(len(pairs)) + 1))
        assert got[0].tolist() == pairs and got[1].tolist() == list(range(1, len(pairs) + 1))
