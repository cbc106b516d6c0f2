"""Alignment of two tokenizers against the libraries and plain overlaps of byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vecshelf.llm import cross_tokens
from vecshelf.llm.bpe import byte_symbols
from vecshelf.llm.queries import queries

SF = "/root/testdata/sf0.01"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    a.no_padding()
    a.no_truncation()
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def overlaps(a, b):
    """Groups and linked places of two lists of token bytes, by their byte ranges alone."""
    def ranges(tokens):
        ends = np.cumsum([len(t) for t in tokens]).tolist()
        return list(zip([0, *ends], ends))

    left, right = ranges(a), ranges(b)
    cuts = sorted({e for _, e in left} & {e for _, e in right})
    groups = [([], []) for _ in cuts]
    for side, found in enumerate((left, right)):
        g = 0
        for i, (_, end) in enumerate(found):
            groups[g][side].append(i)
            g += end == cuts[g]
    links, j = [], 0
    for i, (start, end) in enumerate(left):
        while right[j][1] <= start:
            j += 1
        k = j
        while k < len(right) and right[k][0] < end:
            links.append((i, k))
            k += 1
    return groups, links


def brute(docs, a, b):
    symbols = {s: i for i, s in enumerate(byte_symbols())}
    linked, figures, counts = {}, {}, Counter()
    for n, (_, text) in enumerate(docs):
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(symbols[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids_b
        ]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            figures[n], linked[n] = (0, 0, 0, ""), []
            continue
        groups, links = overlaps(bytes_a, bytes_b)
        spelled = ";".join(f"{','.join(str(ids_a[i]) for i in x)}|{','.join(str(ids_b[i]) for i in y)}" for x, y in groups)
        figures[n] = (len(ids_a), len(ids_b), len(groups), hashlib.sha256(spelled.encode()).hexdigest())
        linked[n] = [(ids_a[i], ids_b[j]) for i, j in links]
        counts.update(linked[n])
    highest = defaultdict(int)
    for (_, y), count in counts.items():
        highest[y] = max(highest[y], count)
    return [
        (docs[n][0], *figures[n][:3], len(linked[n]), sum(counts[p] == highest[p[1]] for p in linked[n]),
         sum(counts[p] for p in linked[n]), figures[n][3])
        for n in range(len(docs))
    ]


def order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query_against_brute_force(spark, both):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert order(queries()["op12_cross_tokens"](spark, SF).collect()) == order(brute(docs, *both))


@pytest.mark.parametrize("sent", [1_000_000, 300, 0])
def test_edges(spark, both, sent):
    rng = random.Random(3)
    texts = [None, "", " ", "▁x", "a\x00b", "<|endoftext|> <s> </s> <0x41>", "日本語の文 é\U0001f389\U0001f468‍\U0001f469", "\n\n\t  x  y ",
             "it's " * 5_000, "same words here", "same words here", "!" * 700, "ﬁ ① Å", "a" * 30_000]
    texts += ["".join(rng.choice("ab éñ中1.,'\n \U0001f389") for _ in range(rng.randrange(90))) for _ in range(150)]
    docs = [(None if i == 9 else i % 160, t) for i, t in enumerate(texts)]
    rows = [(*d, "b", 4, 0.5) for d in docs]
    table = spark.createDataFrame(rows, "doc_id long, text string, block string, pair int, count double")
    assert order(cross_tokens.aligned(table, A, B, sent_pairs=sent).collect()) == order(brute(docs, *both))
    assert cross_tokens.aligned(table.limit(0), A, B).collect() == []


def test_shared_cuts_are_all_found():
    """Bisection finds every common end, also far from the middle and in intervals without any."""
    rng = np.random.default_rng(1)
    for _ in range(60):
        ends_a, ends_b, last_a, last_b, at = [], [], [], [], 0
        for _ in range(rng.integers(1, 6)):
            size = int(rng.integers(1, 400))
            a, b = (np.unique(np.append(rng.integers(1, size + 1, rng.integers(0, size)), size)) for _ in range(2))
            ends_a.append(a + at)
            ends_b.append(b + at)
            at += size
            last_a.append(sum(map(len, ends_a)) - 1)
            last_b.append(sum(map(len, ends_b)) - 1)
        a, b = np.concatenate(ends_a), np.concatenate(ends_b)
        cut_a, cut_b = cross_tokens.shared_cuts(a, b, np.array(last_a), np.array(last_b))
        assert (a[cut_a] == b[cut_b]).all()
        assert set(a[cut_a].tolist()) == set(a.tolist()) & set(b.tolist()) and len(set(cut_a.tolist())) == len(cut_a)


def test_long_gap_without_cuts():
    """Odd against even ends: nothing is shared but the last."""
    a, b = np.arange(1, 100_001, 2), np.append(np.arange(2, 99_999, 2), 99_999)
    cut_a, cut_b = cross_tokens.shared_cuts(a, b, np.array([len(a) - 1]), np.array([len(b) - 1]))
    assert a[cut_a].tolist() == [99_999] == b[cut_b].tolist()


def test_same_ids_as_library(both):
    """The merges as ranks give the ids of the vocabulary file itself."""
    rng = random.Random(2)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x3000), 10, 32, 32])) for _ in range(120)) for _ in range(400)]
    texts += [" " * 3000 + "x", "\t\n" * 900, "<|endoftext|>" * 30, "x" * 5000]
    for (ids, _), found in zip(cross_tokens.tokenizers(A, B).encode(texts), both[0].encode_batch([" " + t for t in texts], add_special_tokens=False)):
        assert ids in ([], found.ids)
