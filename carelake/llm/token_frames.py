"""Token ids in seekable zstandard files.

A shard holds documents in id order.  Its ids (little-endian, 2 or 4 bytes) are
cut into independent zstandard frames, at document ends where possible; a longer
document spans several.  Then follows the document table (id, token count) in a
skippable frame, and last the seek table of the public seekable format: sizes and
an XXH64 checksum (low 32 bits) of each frame.  A reader fetches the tail, then
only the frames of the documents it wants, and verifies their checksums.

Documents are dealt to shards by id range, so shards need no global sort and are
in order.  A task writes under a name of its own attempt and reports it in the
manifest, so files of lost tasks are never read.

Defined results: null and empty texts are one end id; null ids come first;
documents that repeat an id stand side by side, ordered by a hash of their text.
"""

from __future__ import annotations

import io
import json
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from itertools import compress, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch

# Fixed values of the zstandard formats.
TABLE_MAGIC, SEEK_MAGIC, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES = 1 << 17
GROUP_CHARS = 1 << 22  # of texts that are encoded together
# Characters whose normalisation, case and class are the same in any Unicode version.
PLAIN = re.compile("[!-~¡-ÿ]*")
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts, as the tokenizers library gives them.

    Where the tokenizer works on words (drops white space, has a splitting pattern
    and ids that end a word), texts are cut at white space, plain chunks by its own
    pattern, and each distinct chunk and word is encoded once; a cache that is full
    is dropped.  Other texts are encoded whole.
    """

    def __init__(self, path: str, most_words: int = 300_000):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            self.tokenizer = Tokenizer.from_str(text := file.read())
        config, self.most = json.loads(text), most_words
        self.cache: dict[str, bytes] = {}  # of chunks between white space
        self.words: dict[str, bytes] = {}  # of words as the pattern cuts them
        vocabulary = self.tokenizer.get_vocab()
        self.kind = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.pattern = _word_pattern(config)
        if self.pattern:  # the same model without steps that leave plain lower-cased words as they are
            own = config["pre_tokenizer"]["pretokenizers"][1]
            bytewise = pre_tokenizers.ByteLevel(add_prefix_space=own["add_prefix_space"], use_regex=own["use_regex"])
            self.cut = Tokenizer(self.tokenizer.model)
            self.cut.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytewise])
        suffix = config["model"].get("end_of_word_suffix")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if self.pattern and suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # texts that do not fall apart at white space: added tokens, and characters that only Python takes for white space
        self.whole = [t["content"] for t in config["added_tokens"]] + ["\x1c", "\x1d", "\x1e", "\x1f"]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes."""
        out: list[bytes | None] = [None] * len(texts)
        apart = [k for k, t in enumerate(texts) if self.pattern and not any(x in t for x in self.whole)]
        if apart:
            for k, ids in zip(apart, self._by_chunk(pa.array([texts[k] for k in apart], pa.large_string()))):
                out[k] = ids
        rest = [k for k, x in enumerate(out) if x is None]
        for k, ids in zip(rest, self._encoded([texts[k] for k in rest])):
            out[k] = ids
        return out

    def _by_chunk(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts that fall apart at white space: each distinct chunk is looked up once, its ids are laid out by position."""
        if len(self.cache) > self.most:
            self.cache.clear()
        if len(self.words) > self.most:
            self.words.clear()
        self.cache[""] = self.words[" "] = b""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        missing = list(filterfalse(self.cache.__contains__, chunks))
        self.cache.update(zip(missing, self._chunks(missing)))
        held = list(map(self.cache.__getitem__, chunks))
        ids = np.frombuffer(b"".join(held), self.kind)
        size = np.fromiter(map(len, held), np.int64, len(held)) // ids.itemsize
        which = coded.indices.to_numpy()
        start, size = (np.cumsum(size) - size)[which], size[which]
        upto = np.concatenate([[0], np.cumsum(size)])
        data = ids[np.repeat(start - upto[:-1], size) + np.arange(upto[-1])].tobytes()
        ends = (upto[split.offsets.to_numpy() - split.offsets[0].as_py()] * ids.itemsize).tolist()
        return [data[lo:hi] for lo, hi in zip(ends, ends[1:])]

    def forget(self) -> None:
        """Drop the caches; a worker process outlives its task and should not keep their memory."""
        self.cache.clear()
        self.words.clear()

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of texts without white space; the plain ones are cut into words together, blanks between them."""
        fit = [PLAIN.fullmatch(c) is not None for c in chunks]
        plain = iter(self._plain(list(compress(chunks, fit))))
        rest = iter(self._encoded([c for c, ok in zip(chunks, fit) if not ok]))
        return [next(plain if ok else rest) for ok in fit]

    def _plain(self, chunks: list[str]) -> list[bytes]:
        if not chunks:
            return []
        words = self.pattern.findall(" ".join(chunks).lower())
        missing = list(set(filterfalse(self.words.__contains__, words)))
        if missing:
            self.words.update(zip(missing, self._missing(missing)))
        ids = list(map(self.words.__getitem__, words))
        upto = np.cumsum(list(map(len, ids)))
        ends = [*upto[[k for k, w in enumerate(words) if w == " "]].tolist(), int(upto[-1])]
        data = b"".join(ids)
        return [data[lo:hi] for lo, hi in zip([0, *ends], ends)]

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, self.kind).tobytes()

    def _missing(self, words: list[str]) -> list[bytes]:
        data = self._bytes(self.cut.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids)
        ends = (np.flatnonzero(self.ends[np.frombuffer(data, self.kind)]) + 1) * np.dtype(self.kind).itemsize
        if len(ends) == len(words) and ends[-1] == len(data):
            ends = ends.tolist()
            return [data[lo:hi] for lo, hi in zip([0, *ends], ends)]
        return self._encoded(words)


def _word_pattern(config: dict):
    """Splitting pattern, for plain characters and blanks, of a tokenizer that works word by word, else None."""
    kinds = [x["type"] for x in (config.get("normalizer") or {}).get("normalizers", [])]
    parts = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if kinds == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in parts] == ["Split", "ByteLevel"] and parts[0]["invert"]:
        pattern = parts[0]["pattern"]["Regex"]
        for kind in "LN":
            members = [c for c in map(chr, range(0x21, 0x100)) if unicodedata.category(c)[0] == kind]
            pattern = pattern.replace(f"\\p{{{kind}}}", "".join(members))
        if "\\p" not in pattern:
            return re.compile(f"{pattern}| ")
    return None


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, by its scheme."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


class ShardWriter:
    """Streams one shard; memory holds one frame and the document table."""

    def __init__(self, out, kind: str):
        self.out, self.kind, self.parts, self.waiting = out, kind, [], 0
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(ids) // np.dtype(self.kind).itemsize)
        if self.waiting and self.waiting + len(ids) > FRAME_BYTES:
            self._flush()
        for at in range(0, len(ids), FRAME_BYTES):
            piece = ids[at:at + FRAME_BYTES]
            self.parts.append(piece)
            self.waiting += len(piece)
            if self.waiting >= FRAME_BYTES:
                self._flush()

    def _flush(self) -> None:
        data = b"".join(self.parts)
        packed = self.compressor.compress(data)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.out.write(packed)
        self.parts, self.waiting = [], 0

    def close(self) -> int:
        """Write what waits, the document table and the seek table; gives the tokens written."""
        if self.parts:
            self._flush()
        table = pa.table({"id": pa.array(self.ids, pa.int64()), "n": pa.array(self.counts, pa.int64())})
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, table.schema.with_metadata({"kind": self.kind})) as writer:
            writer.write_table(table)
        packed = self.compressor.compress(sink.getvalue())
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(packed)) + packed)
        self.frames.append((len(packed) + 8, 0, 0))
        entries = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(entries) + len(footer)) + entries + footer)
        return sum(self.counts)


class ShardReader:
    """Random access to one shard."""

    def __init__(self, path: str):
        system, inner = file_system(path)
        self.file = system.open_input_file(inner)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError(f"{path} is no seekable file with checksums")
        raw = self.file.read_at(12 * count, size - 9 - 12 * count)
        self.frames = np.frombuffer(raw, "<u4").reshape(-1, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.starts = np.concatenate([[0], np.cumsum(self.frames[:, 1])])
        packed = self.file.read_at(self.frames[-1, 0] - 8, self.offsets[-2] + 8)
        table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompressobj().decompress(packed)).read_all()
        self.kind = table.schema.metadata[b"kind"].decode()
        self.ids, self.counts = table["id"].to_pylist(), table["n"].to_numpy()
        self.at = np.concatenate([[0], np.cumsum(self.counts)])
        self._last = (-1, b"")

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            data = zstandard.ZstdDecompressor().decompress(self.file.read_at(self.frames[k, 0], self.offsets[k]))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.frames[k, 2]:
                raise ValueError(f"frame {k} is damaged")
            self._last = (k, data)
        return self._last[1]

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, from its frames only."""
        width = np.dtype(self.kind).itemsize
        lo, hi = int(self.at[k]) * width, int(self.at[k + 1]) * width
        first = int(np.searchsorted(self.starts, lo, "right")) - 1
        parts, frame = [], first
        while lo < hi:
            data, base = self._frame(frame), int(self.starts[frame])
            parts.append(data[lo - base:hi - base])
            lo = min(hi, base + len(data))
            frame += 1
        return np.frombuffer(b"".join(parts), self.kind)

    def find(self, doc_id: int | None) -> Iterator[np.ndarray]:
        """Ids of the documents with this id."""
        return (self.document(k) for k, x in enumerate(self.ids) if x == doc_id)


def _write(folder: str, tokenizer: str, end_id: int):
    def run(batches):
        codec, shard = encoder(tokenizer), TaskContext.get().partitionId()
        system, inner = file_system(folder)
        name, writer, out = f"shard-{shard:06d}-{uuid.uuid4().hex[:12]}.zst", None, None
        end = np.array([end_id], codec.kind).tobytes()
        for batch in batches:
            upto = np.cumsum(pc.fill_null(pc.utf8_length(batch["text"]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            bounds = np.flatnonzero(np.diff(upto // GROUP_CHARS, prepend=-1))
            for lo, hi in zip(bounds.tolist(), [*bounds[1:].tolist(), batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                if writer is None and part.num_rows:
                    out = system.open_output_stream(f"{inner}/{name}", compression=None)
                    writer = ShardWriter(out, codec.kind)
                for doc_id, ids in zip(part["id"].to_pylist(), codec.encode(part["text"].to_pylist())):
                    writer.add(doc_id, ids + end)
        if writer is not None:
            tokens = writer.close()
            out.close()
            codec.forget()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{folder}/{name}"], "n_docs": [len(writer.ids)],
                                              "n_tokens": [tokens]}, schema=MANIFEST)

    return run


MANIFEST = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def write_shards(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> DataFrame:
    """Write the documents' ids; gives the manifest: shard, path, documents, tokens, tokens before (``first``)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    folder = f"{scratch.path}/shards"
    system, inner = file_system(folder)
    system.create_dir(inner, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    manifest = rows.select("id", "text").mapInArrow(_write(folder, tokenizer, end_id), "shard long, path string, n_docs long, n_tokens long")
    shards = scratch.save(manifest, "manifest").orderBy("shard").collect()  # one row per file
    first, listed = 0, []
    for s in shards:
        listed.append((s["shard"], s["path"], s["n_docs"], s["n_tokens"], first))
        first += s["n_tokens"]
    return spark.createDataFrame(listed, "shard long, path string, n_docs long, n_tokens long, first long")


def _digest(batches):
    for batch in batches:
        for path, first in zip(batch["path"].to_pylist(), batch["first"].to_pylist()):
            reader = ShardReader(path)
            for lo in range(0, len(reader.ids), 4096):
                span = range(lo, min(len(reader.ids), lo + 4096))
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array([reader.ids[k] for k in span], pa.int64()),
                    "start": [first + int(reader.at[k]) for k in span],
                    "n_tokens": [int(reader.counts[k]) for k in span],
                    "ids_crc32": [zlib.crc32(reader.document(k).astype("<u4").tobytes()) for k in span],
                })


def digests(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Read every shard back: id, ``start``, ``n_tokens``, ``ids_crc32`` per document."""
    files = manifest.select("path", "first")
    files = files.repartition(max(1, min(manifest.count(), 4 * files.sparkSession.sparkContext.defaultParallelism)), "path")
    return files.mapInArrow(_digest, "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)
