"""Token ids as files of independent zstandard frames with a trailing seek table.

A shard holds the documents of one range of doc_id, one frame per document (ids as little-endian unsigned
32-bit integers, the end id last), then a skippable frame with the documents' ids, then a seek table in
the public seekable format of zstandard: a skippable frame with the compressed size, the size and the
checksum (the low 32 bits of XXH64) of every frame, the number of frames, and a closing mark. A reader
finds a document from the end of the file and decompresses that frame alone.

    frames | document ids (skippable) | seek table (skippable)

Shards are written by Spark tasks. A retried task writes a file of its own name, and the manifest (one
row per shard, itself a written table) names the files that count, so lost executors leave no trace.
The manifest also says how many ids precede each shard.

Defined cases: null and empty texts hold the end id alone. Documents are in ascending doc_id order, null
first; rows with the same doc_id stay separate, ordered by the hash of their text. An empty table has no
shard. A single document is limited to 4 GB of ids, the format's limit.
"""

from __future__ import annotations

import struct
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import id_and_text, map_arrow, scratch, settle, slices

END_ID = 1
LEVEL = 3
#: Pieces of a generation that a worker keeps; two generations are some 200 MB.
KEPT_PIECES = 600_000
#: Bytes of text whose pieces are numbered together.
ENCODED_BYTES = 8 << 20
#: ASCII punctuation but the apostrophe, which can begin a word.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Of the public zstandard formats: two skippable frames, the seek table's closing mark, checksums present.
INDEX_MAGIC, SEEK_MAGIC, SEEK_END, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
#: size and checksum fields of a frame, and the seek table's footer
ENTRY, FOOTER, HEADER = struct.Struct("<III"), struct.Struct("<IBI"), struct.Struct("<II")
SHARD = (
    "shard int, file string, n_docs long, n_tokens long, n_bytes long, first_doc long, last_doc long"
)


class LibraryEncoder:
    """Encodes whole texts with the tokenizers library.

    No word, special token or composed character of the vocabulary reaches across ASCII white space, so
    the ids of a text are those of its pieces. Arrow cuts the texts of a slice and numbers their different pieces; only
    for each different piece is there work in Python, and its ids are put in the places of its numbers by numpy.

    The vocabulary ignores case and parts words from punctuation, so a piece of ASCII alone that ends in punctuation has
    the ids of its lower-cased core and of that ending, which occur more often. A core of the letters a to z passes the
    library's normaliser and pre-tokenizer unchanged and as one word, so it goes to the library's model at once. Other pieces
    go to the library as they are: it composes characters before it lower-cases them. Two generations of pieces are kept.
    """

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        from tokenizers import Tokenizer

        self.library, self.kept = Tokenizer.from_file(path), kept
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.packed = [struct.pack("<I", i) for i in range(self.library.get_vocab_size())]
        self.pieces: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}

    def lookup(self, wanted: list[bytes]) -> None:
        """Makes sure that all of them are kept."""
        kept, older, packed = self.pieces, self.older, self.packed
        kept.update([(p, older[p]) for p in wanted if p in older])
        new = [p for p in wanted if p not in kept]
        words = [x for x in new if x.isalpha() and x.isascii() and x.islower()]
        tokenize = self.model.tokenize
        kept.update([(x, b"".join([packed[t.id] for t in tokenize(x.decode())])) for x in words])
        others = [x for x in new if x not in kept]
        found = self.library.encode_batch_fast([x.decode("utf-8", "replace") for x in others], add_special_tokens=False)
        kept.update([(x, b"".join([packed[i] for i in e.ids])) for x, e in zip(others, found, strict=True)])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        return self.encode_column(pa.array(texts, pa.binary()).view(pa.string()))

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """The packed ids of every text (no nulls)."""
        if len(self.pieces) > self.kept:
            self.older, self.pieces = self.pieces, {b"": b""}
        cut = pa.compute.ascii_split_whitespace(texts)
        pieces = cut.flatten().dictionary_encode()
        parts = pa.concat_arrays(parted(pieces.dictionary)).dictionary_encode()
        words, kept = parts.dictionary.cast(pa.binary()).to_pylist(), self.pieces
        if wanted := [p for p in words if p not in kept]:
            self.lookup(wanted)
        found = [kept[p] for p in words]
        sizes = np.array([len(x) for x in found], np.int64) // 4
        # the ids of every different piece: those of its core, then of its ending
        pairs = parts.indices.to_numpy().reshape(2, -1).T
        flat = gathered(np.frombuffer(b"".join(found), "<u4"), sizes, pairs.ravel())
        sizes = sizes[pairs].sum(1)
        numbers = pieces.indices.to_numpy()
        ids = gathered(flat, sizes, numbers).tobytes()
        stops = np.r_[0, np.cumsum(sizes[numbers])]
        offsets = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        bounds = (4 * stops[offsets]).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]


def gathered(flat: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The runs of `flat` of these numbers, one behind the other; sizes: of all runs."""
    starts, lengths = np.cumsum(sizes) - sizes, sizes[numbers]
    stops = np.cumsum(lengths)
    source = np.repeat(starts[numbers] - stops + lengths, lengths)
    source += np.arange(len(source))
    return flat[source]


def parted(pieces: pa.StringArray) -> list[pa.StringArray]:
    """Of every piece a core and an ending (or none) whose ids, one after the other, are those of the piece."""
    call = pa.compute
    # other pieces may have letters that compose before case is lost, or a special token
    plain = call.and_(call.string_is_ascii(pieces), call.invert(call.match_substring(pieces, "<|")))
    trimmed = call.ascii_rtrim(pieces, characters=MARKS)
    ends = call.and_(plain, call.match_substring_regex(trimmed, "[0-9A-Za-z]$"))
    core = call.if_else(ends, trimmed, pieces)
    size = (call.binary_length(pieces).to_numpy() - call.binary_length(core).to_numpy()).astype(np.int32)
    held = np.zeros(2 * len(size), np.int64)  # of every piece what stays in the core, then its ending
    held[0::2], held[1::2] = call.binary_length(core).to_numpy(), size
    text = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)  # of a dictionary, whose buffer starts with its first piece
    endings = gathered(text, held, np.arange(1, len(held), 2))
    offsets = np.r_[0, np.cumsum(size)].astype(np.int32)
    ending = pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets.tobytes()), pa.py_buffer(endings.tobytes()))
    return [call.if_else(plain, call.ascii_lower(core), pieces), ending]


@cache
def library_encoder(path: str) -> LibraryEncoder:
    """One per Python worker, single-threaded: Spark runs the tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return LibraryEncoder(path)


class ShardWriter:
    """Writes one shard to an open binary file."""

    def __init__(self, out, level: int = LEVEL):
        import zstandard

        self.out, self.frame = out, zstandard.ZstdCompressor(level, write_content_size=True, write_checksum=True)
        self.entries: list[bytes] = []
        self.doc_ids: list[int | None] = []
        self.n_tokens = self.n_bytes = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.frame.compress(ids)
        self.out.write(frame)
        self.entries.append(ENTRY.pack(len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.doc_ids.append(doc_id)
        self.n_tokens += len(ids) // 4
        self.n_bytes += len(frame)

    def close(self) -> None:
        named = np.array([d is not None for d in self.doc_ids], np.uint8).tobytes()
        index = named + np.array([d or 0 for d in self.doc_ids], "<i8").tobytes()
        self.out.write(HEADER.pack(INDEX_MAGIC, len(index)) + index)
        table = b"".join(self.entries) + FOOTER.pack(len(self.entries), CHECKSUMS, SEEK_END)
        self.out.write(HEADER.pack(SEEK_MAGIC, len(table)) + table)


class ShardReader:
    """Reads the seek table of an open shard, then single documents."""

    def __init__(self, source):
        import zstandard

        self.source, self.frame = source, zstandard.ZstdDecompressor()
        end = source.size()
        n, flags, mark = FOOTER.unpack(self.read(end - FOOTER.size, FOOTER.size))
        if mark != SEEK_END or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the shard")
        size = n * ENTRY.size
        table = np.frombuffer(self.read(end - FOOTER.size - size, size), "<u4").reshape(-1, 3).astype(np.int64)
        self.sizes, self.checksums = table[:, 1], table[:, 2]
        self.starts = np.r_[0, np.cumsum(table[:, 0])]
        index = self.read(int(self.starts[-1]) + HEADER.size, 9 * n)
        ids = np.frombuffer(index, "<i8", n, n).tolist()
        self.doc_ids = [d if named else None for d, named in zip(ids, index[:n], strict=True)]

    def read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def ids(self, place: int) -> bytes:
        start, stop = int(self.starts[place]), int(self.starts[place + 1])
        ids = self.frame.decompress(self.read(start, stop - start), max_output_size=int(self.sizes[place]))
        if len(ids) != self.sizes[place] or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != self.checksums[place]:
            raise ValueError(f"document {self.doc_ids[place]} is damaged")
        return ids


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Encodes the documents into shards below `folder`; gives the manifest, with `base`: ids in earlier shards."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        writer = out = None
        first = last = None
        shard, coder = TaskContext.get().partitionId(), library_encoder(path)
        file = f"{folder}/shard-{shard:07d}-{uuid.uuid4().hex}.zst"
        for batch in slices(batches, size=ENCODED_BYTES):
            if writer is None:
                system, place = fs.FileSystem.from_uri(file)
                out = system.open_output_stream(place, compression=None)
                writer = ShardWriter(out)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coder.encode_column(batch.column("text")), strict=True):
                writer.add(doc_id, ids + end)
                first, last = doc_id if first is None else first, doc_id if doc_id is not None else last
        if writer is not None:
            writer.close()
            out.close()
            row = (shard, file, len(writer.doc_ids), writer.n_tokens, writer.n_bytes, first, last)
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], [c.split()[0] for c in SHARD.split(", ")]
            )

    tie = F.xxhash64("text")
    ordered = id_and_text(docs).repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    manifest = settle(map_arrow(ordered, run, SHARD), "manifest")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))


def read(manifest: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it) and token_ids (packed) of all documents or of those wanted.

    For wanted documents only shards that may hold them are opened, and only their frames decompressed.
    """
    asked = None if wanted is None else sorted(set(wanted))

    def may_hold(first: int | None, last: int | None) -> bool:
        """Whether an asked document can be in a shard of these ids (none: of documents without id)."""
        if asked is None or last is None:
            return asked is None
        at = 0 if first is None else bisect_left(asked, first)
        return at < len(asked) and asked[at] <= last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        chosen = None if asked is None else set(asked)
        for batch in batches:
            for row in batch.to_pylist():
                file, base = row["file"], row["base"]
                if not may_hold(row["first_doc"], row["last_doc"]):
                    continue
                system, place = fs.FileSystem.from_uri(file)
                with system.open_input_file(place) as source:
                    shard = ShardReader(source)
                    starts = base + np.r_[0, np.cumsum(shard.sizes // 4)]
                    rows: list[tuple] = []
                    held = 0
                    for i, doc_id in enumerate(shard.doc_ids):
                        if chosen is None or doc_id in chosen:
                            rows.append((doc_id, int(starts[i]), shard.ids(i)))
                            held += len(rows[-1][2])
                        if held > 4 << 20 or len(rows) >= 10_000:
                            yield batch_of(rows)
                            rows, held = [], 0
                    yield batch_of(rows)

    # a task per shard: by a stated number, which adaptive execution leaves as it is
    spread = manifest.select("file", "base", "first_doc", "last_doc").repartition(max(1, manifest.count()), "file")
    return map_arrow(spread, run, "doc_id long, start long, token_ids binary")


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    doc_ids, starts, ids = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "start", "token_ids"]
    )


def digests(rows: DataFrame) -> DataFrame:
    """The contract's columns of what `read` gives."""
    return rows.select(
        "doc_id",
        "start",
        F.floor(F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("token_ids").cast("long").alias("ids_crc32"),
    )


def round_trip(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    return digests(read(write(docs, scratch(spark, "tokens"), path)))
