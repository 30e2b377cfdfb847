import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tierflow.llm import packing
from tierflow.llm.packing import best_two_fit, cuts, packed_documents

from .cases import edge_texts, frame, prose


def one_by_one(counts, capacity):
    """The method, a sequence at a time."""
    left, bins = Counter(counts), []
    while +left:
        def largest(room):
            return max((x for x in left if left[x] > 0 and x <= room), default=None)

        bin_ = []
        gap = capacity
        while (x := largest(gap)) is not None and gap:
            bin_.append(x)
            left[x] -= 1
            gap -= x
        while gap and len(bin_) > 1:
            small = min(bin_)
            free = sorted(+left, reverse=True)
            pairs = [(a + b, a, b) for a in free for b in free if b <= a and a + b <= gap + small and (a != b or left[a] > 1)]
            if not pairs or max(pairs)[0] <= small:
                break
            total, a, b = max(pairs)
            bin_.remove(small)
            left[small] += 1
            for x in (a, b):
                left[x] -= 1
                bin_.append(x)
            gap += small - total
        bins.append(tuple(sorted(bin_, reverse=True)))
    return Counter(bins)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 9), max_size=12))
def test_plan_equals_packing_one_by_one(counts):
    plan = Counter()
    for lengths, copies in best_two_fit(counts, 24):
        plan[tuple(lengths)] += copies
    assert plan == one_by_one(counts, 24)


def test_cuts():
    assert cuts(5, 4) == [(0, 1), (1, 4)]
    assert cuts(8, 4) == [(0, 4), (4, 4)]
    assert cuts(4, 4) == [(0, 4)]


def test_ids_equal_the_tokenizer():
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words = packing.word_ids(packing.vocabulary_path())
    random_ = random.Random(5)
    odd = "ab Z9'\t\n\r\x0b\x1c\x85\xa0" + "".join(map(chr, (0x2003, 0x3000, 0x200B, 0xE9, 0x6F22, 0x1F600))) + "s.,-_|"
    texts = [t or "" for t in edge_texts()] + ["".join(random_.choices(odd, k=random_.randint(1, 40))) for _ in range(800)] + [
        "it's we're I'll <|endoftext|> x", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n b ", " <|endoftext|", "<|endoftext|>'s", "1 <|endoftext|>  2",
    ]
    for text, want in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(words.encode(text), "<u4").tolist() == want.ids


def test_packed_documents(spark):
    texts = edge_texts() + [prose(k, k % 90 + 1) for k in range(300)] + ["a <|endoftext|> b"]
    ids = [None, 7, 7, *range(3, len(texts))]
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packed_documents(frame(spark, texts, ids)).collect()
    places = defaultdict(list)
    found = defaultdict(list)
    for row in rows:
        places[row.sequence_id].append((row.offset, row.length))
        found[row.doc_id].append((row.piece, row.start, row.length, row.ids_crc32))
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= 1024
    for doc_id, text in zip(ids, texts, strict=True):
        own = reference.encode(text or "", add_special_tokens=False).ids + [2]
        want = [(k, s, n, zlib.crc32(np.array(own[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(cuts(len(own)))]
        assert set(want) <= set(found[doc_id])
    total = sum(row.length for row in rows)
    assert sum(map(len, found.values())) == len(rows) and len(places) <= total / 1024 + 2


def test_empty_table(spark):
    assert packed_documents(frame(spark, [])).count() == 0
