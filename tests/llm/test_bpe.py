"""Byte-pair coding and the token files against the library itself."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from daybook.llm import bpe, token_files
from daybook.llm.common import scratch, settle
from tests.llm import tables

AWKWARD = [
    "", "Hello <|endoftext|>world", "a<|startoftext|>b  c", "ΑΣ ΟΔΟΣ.", "İstanbul", "don't 12 x² ½", "'s 'S it'S I'LL",
    "aaaaaaa bbbb !!!!!!!", "é ́ x́", "\x85a b​c\x00d\x1cq", "日本語 テスト", "<|ENDOFTEXT|>", "՘xꟋ",
    "a" * 3001, "!" * 2000 + "ab" * 1000, "<|endoftext|>" * 3, "x<|endoftext|>.. THE!! Thé.. é,, 12.. don't's!", "é̸ x.̸",
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(bpe.default_path())
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def texts():
    random.seed(1)
    letters = ["a", "B", "an", "the", "'", "!", ".", " ", "\n", "é", "é", "<|endoftext|>", "Σ", "1", "　", "ǅ", "👋", "日", "’"]
    return AWKWARD + ["".join(random.choices(letters, k=random.randint(0, 40))) for _ in range(3000)]


@pytest.mark.parametrize("encoder", [lambda: bpe.Bpe(bpe.default_path(), 50), lambda: token_files.LibraryEncoder(bpe.default_path(), 50)])
def test_ids_are_the_library_s(library, texts, encoder):
    coder = encoder()
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for i in range(0, len(texts), 500):  # several batches, so that kept pieces are dropped in between
        found = coder.encode([t.encode() for t in texts[i : i + 500]])
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == expected[i : i + 500]


@pytest.mark.parametrize("pair", ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a"])
def test_capitals_that_compose_only_in_lower_case(library, pair):
    texts = [pair, f"{pair}ON, a{pair}", f"({pair}n)."]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for coder in (bpe.Bpe(bpe.default_path()), token_files.LibraryEncoder(bpe.default_path())):
        assert [np.frombuffer(f, "<u4").tolist() for f in coder.encode([t.encode() for t in texts])] == expected


def test_decoding_is_the_library_s(library, texts):
    coder = bpe.Bpe(bpe.default_path())
    for text, ids in zip(texts, coder.encode([t.encode() for t in texts]), strict=True):
        assert coder.decode(ids) == library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False), text


def test_query_rows(spark, library):
    docs = tables.documents(spark, AWKWARD)
    expected = []
    for row in docs.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        expected.append((row["doc_id"], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert tables.rows(bpe.digests(bpe.encode_decode(docs, bpe.default_path()))) == sorted(expected, key=str)
    assert bpe.digests(bpe.encode_decode(tables.empty(spark), bpe.default_path())).count() == 0


def test_token_files_round_trip(spark, library):
    docs = tables.documents(spark, AWKWARD)
    found = token_files.round_trip(spark, docs, bpe.default_path()).orderBy("start").collect()
    wanted = {}
    for row in docs.collect():
        ids = np.array([*library.encode(row["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        wanted.setdefault(row["doc_id"], []).append((len(ids), zlib.crc32(ids.tobytes())))
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))  # nulls first, then ascending
    start = 0
    for row in found:
        assert row["start"] == start
        start += row["n_tokens"]
        wanted[row["doc_id"]].remove((row["n_tokens"], row["ids_crc32"]))
    assert not any(wanted.values())
    assert token_files.round_trip(spark, tables.empty(spark), bpe.default_path()).count() == 0


def test_single_documents_and_damage(spark, tmp_path):
    docs = tables.documents(spark)
    manifest = settle(token_files.write(docs, scratch(spark, "tokens"), bpe.default_path()), "manifest")
    all_rows = tables.rows(token_files.read(manifest))
    assert tables.rows(token_files.read(manifest, [7, 3, 10**9])) == [r for r in all_rows if r[0] in (3, 7)]
    path = tmp_path / "shard"
    with path.open("wb") as out:
        writer = token_files.ShardWriter(out)
        for i in range(3):
            writer.add(i, np.arange(100 * i, dtype="<u4").tobytes())
        writer.close()
    from pyarrow import fs

    with fs.LocalFileSystem().open_input_file(str(path)) as source:
        shard = token_files.ShardReader(source)
        assert shard.doc_ids == [0, 1, 2] and len(shard.ids(2)) == 800 and shard.ids(0) == b""
        shard.checksums[1] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            shard.ids(1)
    import zstandard

    frames = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True)
    assert len(frames.decompress(path.read_bytes())) == 1200  # any zstandard reader skips index and seek table
