"""Tokenized operators: exact ids, packing, and the round trip through token files."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from grantlens.llm import packing, tokenfiles
from grantlens.llm.common import work_folder
from grantlens.llm.tokens import WordEncoder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(VOCABULARY)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_are_the_tokenizers(whole, texts):
    odd = ["", "  ", None, "don't we'll O'Neil's a,'s 's ''ll x'", "Ünï 3.14 1,2 ×÷ é. É́ é. İstanbul ﬁ ½ x² ", "a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|>",
           "\x00 \x1c a\x1cb  x y z　", "ß. Straße; über% ÿ( ñ)", "a̸ b. ćd .́ ≮ )̸", "x" * 5000 + ". " + "." * 3000, "K Å ſ.ſ", "a.'s b('t c\"'re"]
    every = odd + [t for _, t in texts]
    for end in (None, 1):
        ids, marks = WordEncoder(VOCABULARY).of_texts(pa.array(every, pa.string()), end)
        for i, text in enumerate(every):
            want = whole.encode(text or "", add_special_tokens=False).ids + ([] if end is None else [end])
            assert ids[marks[i]:marks[i + 1]].tolist() == want


def test_forgetting_words_changes_nothing(whole, texts, monkeypatch):
    from grantlens.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_WORDS", 3)
    coder = WordEncoder(VOCABULARY)
    for _, text in texts[:20]:
        assert coder.of_texts(pa.array([text]))[0].tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("lengths", [
    np.clip(np.random.default_rng(1).lognormal(6.2, 1, 20_000).astype(int), 1, 4096), np.random.default_rng(2).integers(1000, 4097, 5000), np.full(500, 2049),
    np.array([4096, 1, 1, 1]), np.array([], int), np.full(7, 1365)])
def test_plan_fills_sequences_without_gaps(lengths):
    counts = dict(collections.Counter(lengths.tolist()))
    made = packing.plan(counts)
    held = [[] for _ in range(made.sequences)]
    places = sorted(made.places)
    for at, (length, rank, first, copies, offset) in enumerate(places):
        following = places[at + 1][1] if at + 1 < len(places) and places[at + 1][0] == length else counts[length]
        for r in range(following - rank):
            held[first + r // copies].append((offset + r % copies * length, length))
    assert sum(map(len, held)) == len(lengths)
    for sequence in held:
        end = 0
        for offset, length in sorted(sequence):
            assert offset == end
            end += length
        assert 0 < end <= 4096
    # No worse than first-fit decreasing.
    rooms = []
    for n in sorted(lengths.tolist(), reverse=True)[:3000 if len(lengths) > 6000 else None]:
        i = next((i for i, r in enumerate(rooms) if r >= n), None)
        rooms.append(4096 - n) if i is None else rooms.__setitem__(i, rooms[i] - n)
    if len(lengths) <= 6000:
        assert made.sequences <= max(len(rooms) * 1.02, len(rooms) + 1)
    else:
        assert made.sequences <= 1.01 * lengths.sum() / 4096 + 1


def packed_rows(frame):
    return sorted((r.asDict() for r in frame.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["piece"], r["sequence_id"]))


def check_packing(rows, docs, whole, capacity):
    want = []
    for doc_id, text in docs:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        want += [(doc_id, i // capacity, i, len(ids[i:i + capacity]), crc(ids[i:i + capacity])) for i in range(0, len(ids), capacity)]
    key = lambda x: (x[0] is None, x)
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=lambda x: repr(key(x))) == sorted(want, key=lambda x: repr(key(x)))
    held = collections.defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


def test_pack(documents, texts, whole):
    rows = packed_rows(packing.pack(documents, VOCABULARY))
    used = check_packing(rows, texts, whole, 4096)
    assert used <= 1.05 * sum(r["length"] for r in rows) / 4096 + 1


def test_pack_odd(odd, none, whole):
    from .conftest import ODD

    check_packing(packed_rows(packing.pack(odd, VOCABULARY, 64)), ODD, whole, 64)
    assert packing.pack(none, VOCABULARY).count() == 0


def check_files(rows, docs, whole):
    start, want = 0, []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, (d[1] or "").encode())):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(rows, key=lambda r: r[1]) == want


def test_files_round_trip(documents, texts, whole):
    check_files([tuple(r) for r in tokenfiles.encode_and_read(documents, VOCABULARY).collect()], texts, whole)


def test_files_odd(odd, none, whole):
    from .conftest import ODD

    check_files([tuple(r) for r in tokenfiles.encode_and_read(odd, VOCABULARY, length=16).collect()], ODD, whole)
    assert tokenfiles.encode_and_read(none, VOCABULARY).count() == 0


def test_random_access_and_masks(spark, documents, texts, whole):
    folder = work_folder(spark)
    manifest = tokenfiles.write(documents, folder, VOCABULARY, 2, length=32).orderBy("shard").collect()
    ids = [i for _, t in sorted(texts) for i in whole.encode(t, add_special_tokens=False).ids + [2]]
    at = 0
    for shard in manifest:
        own = ids[at:at + shard["n_tokens"]]
        at += shard["n_tokens"]
        for number in {0, (len(own) - 1) // 32, len(own) // 64}:
            got, mask = tokenfiles.sequence(f"{shard['path']}.ids.arrow", number)
            assert len(got) == len(mask) == 32
            assert got[mask].tolist() == own[32 * number:32 * number + 32]
    assert at == len(ids)
