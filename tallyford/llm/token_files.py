"""Token ids as Arrow stream files of equal-length sequences with masks, read again without copying.

`write` range-partitions documents by id and lets each partition write one shard:

* `shard-00000.arrow`: an Arrow stream of record batches with `input_ids` (fixed-size lists of 16- or 32-bit
  ids) and `mask` (fixed-size lists of booleans: false where the last sequence is padding). All documents of
  the shard, in order, fill the sequences without gaps.
* `shard-00000.docs.arrow`: a stream with `(doc_id, offset, n_tokens)` of its documents.
* a row of the manifest, written last as Parquet: file names, number of ids and the byte offset of every
  record batch. A reader maps a file, goes to any sequence by arithmetic and gets views of the file's bytes.

A task writes under a name of its own and moves the finished files to their final names; what it writes
depends on its rows only, so a repeated task puts the same bytes in the same place. Readers see the files
that the manifest lists. Memory is bounded by a block of sequences and the ids of one text.

Nulls and empty texts are documents with the end id only. Null ids come first; equal ids are ordered by the
hash of their text, equal rows stay separate documents. An empty table has no shards.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .registry import query, table
from .textscan import Texts, slices
from .work import Work, open_folder, result

SEQUENCE = 2048
BATCH_SEQUENCES = 128
# Pieces whose ids a worker remembers; then it starts again. Bounds memory only.
REMEMBERED = 4_000_000

# The first bytes of characters that are no white space, whatever follows them.
_SOLID = np.zeros(256, bool)
_SOLID[[*range(0x21, 0x7F), *range(0xC3, 0xE0), *range(0xE4, 0xF5)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(x) for x in ".,;:!?"]] = True


def pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of byte ranges whose ids in a row are the ids of the texts.

    They begin where the tokenizer's own split always begins a piece: before a space that a solid character
    follows, before and after a line end between solid characters, and before a stop after an ASCII letter.
    """
    x, n = texts.raw, len(texts.raw)
    cut = np.zeros(n, bool)
    if n > 1:
        solid, line = _SOLID[x], x == 10
        cut[:-1] |= (x[:-1] == 32) & solid[1:]
        ascii_solid = solid & (x < 127)
        cut[1:] |= line[1:] & ascii_solid[:-1]
        cut[2:] |= line[1:-1] & ascii_solid[:-2] & solid[2:]
        cut[1:] |= _STOP[x[1:]] & _LETTER[x[:-1]]
    begin = texts.offset[:-1]
    cut[begin[begin < n]] = True
    start = np.flatnonzero(cut)
    return start, np.append(start[1:], n)


class Encoder:
    """Ids of texts, flat; a piece of text is encoded by the tokenizer once and then found by its 64-bit hash."""

    def __init__(self, path: str, kind: str):
        # Spark's tasks are the parallel ones.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), np.dtype(kind)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():
            self.width[i] = len(name)  # byte-level: a character of the vocabulary is a byte of the text
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.known, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 20, self.kind), 0

    def _learn(self, hashes: np.ndarray, found: list[bytes]) -> None:
        # Pieces that begin with a space and a solid character can be encoded in a row and told apart by their bytes.
        joint = np.array([len(p) > 1 and p[0] == 32 and bool(_SOLID[p[1]]) for p in found], bool)
        size = np.zeros(len(found), np.int64)
        got: list[np.ndarray] = []
        order = np.concatenate((np.flatnonzero(joint), np.flatnonzero(~joint)))
        joined = order[:int(joint.sum())]
        texts = [b"".join(found[i] for i in joined[k:k + 500]).decode() for k in range(0, len(joined), 500)]
        for k, encoded in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(encoded.ids, self.kind)
            own = joined[500 * k:500 * k + 500]
            ends = np.cumsum([len(found[i]) for i in own])
            stops = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
            size[own] = np.diff(stops, prepend=0)
            got.append(ids)
        alone = order[len(joined):]
        for i, encoded in zip(alone, self.tokenizer.encode_batch_fast([found[i].decode() for i in alone], add_special_tokens=False)):
            got.append(np.array(encoded.ids, self.kind))
            size[i] = len(got[-1])
        flat = np.concatenate(got) if got else np.zeros(0, self.kind)
        at = np.zeros(len(found), np.int64)
        at[order] = self.used + np.concatenate(([0], np.cumsum(size[order])[:-1]))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used:self.used + len(flat)] = flat
        self.used += len(flat)
        where = np.searchsorted(self.known, hashes)
        self.known, self.at, self.size = (np.insert(x, where, y) for x, y in ((self.known, hashes), (self.at, at), (self.size, size)))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as bytes; a null is an empty text."""
        scanned = Texts(texts, lower=False)
        start, end = pieces(scanned)
        hashes = scanned.ranges(start, end)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self._forget()
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        raw = scanned.raw.tobytes()
        if new.any():
            some = first[new]
            self._learn(distinct[new], [raw[a:b] for a, b in zip(start[some].tolist(), end[some].tolist())])
            place = np.searchsorted(self.known, distinct)
        size, at = self.size[place][which], self.at[place][which]
        total = np.concatenate(([0], np.cumsum(size)))
        flat = self.ids[np.repeat(at - total[:-1], size) + np.arange(total[-1])].tobytes()
        bounds = (total[np.searchsorted(start, scanned.offset)] * self.kind.itemsize).tolist()
        out = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        if any(s in raw for s in self.special):
            for i, (a, b) in enumerate(zip(scanned.offset[:-1].tolist(), scanned.offset[1:].tolist())):
                if any(s in raw[a:b] for s in self.special):
                    ids = self.tokenizer.encode(raw[a:b].decode(), add_special_tokens=False).ids
                    out[i] = np.array(ids, self.kind).tobytes()
        return out


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    if (path, kind) not in _encoders:
        _encoders[path, kind] = Encoder(path, kind)
    return _encoders[path, kind]


class _Shard:
    """Writes the ids of one partition as full record batches, the last one as long as it needs to be."""

    def __init__(self, folder: str, name: str, attempt: str, kind: str, length: int, id_type: pa.DataType):
        self.fs, self.base = open_folder(folder)
        self.name, self.attempt, self.length = name, attempt, length
        self.kind = np.dtype(kind)
        self.schema = pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(self.kind), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.docs_schema = pa.schema([("doc_id", id_type), ("offset", pa.int64()), ("n_tokens", pa.int64())])
        self.fs.create_dir(self.base, recursive=True)
        self.out = self.fs.open_output_stream(self._own("arrow"))
        self.writer = pa.ipc.new_stream(self.out, self.schema)
        self.docs_out = self.fs.open_output_stream(self._own("docs.arrow"))
        self.docs = pa.ipc.new_stream(self.docs_out, self.docs_schema)
        self.waiting: list[bytes] = []
        self.held = self.total = 0
        self.places: list[int] = []

    def _own(self, end: str) -> str:
        return f"{self.base}/_{self.name}-{self.attempt}.{end}"

    def add(self, ids: pa.Array, encoded: list[bytes], end: bytes) -> None:
        size = np.array([len(x) // self.kind.itemsize + 1 for x in encoded], np.int64)
        offset = self.total + np.concatenate(([0], np.cumsum(size)[:-1]))
        self.docs.write_batch(pa.record_batch([ids, pa.array(offset), pa.array(size)], schema=self.docs_schema))
        self.total += int(size.sum())
        for x in encoded:
            self.waiting += (x, end)
            self.held += len(x) // self.kind.itemsize + 1
        full = self.length * BATCH_SEQUENCES
        if self.held >= full:
            flat = np.frombuffer(b"".join(self.waiting), self.kind)
            stop = len(flat) // full * full
            for begin in range(0, stop, full):
                self._write(flat[begin:begin + full], full)
            self.waiting, self.held = [flat[stop:].tobytes()], len(flat) - stop

    def _write(self, flat: np.ndarray, used: int) -> None:
        self.places.append(self.out.tell())
        lists = pa.FixedSizeListArray.from_arrays
        mask = np.arange(len(flat)) < used
        self.writer.write_batch(pa.record_batch(
            [lists(pa.array(flat), self.length), lists(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> pa.RecordBatch:
        if self.held:
            flat = np.frombuffer(b"".join(self.waiting), self.kind)
            padded = np.zeros(-(-len(flat) // self.length) * self.length, self.kind)
            padded[:len(flat)] = flat
            self._write(padded, len(flat))
        for x in (self.writer, self.out, self.docs, self.docs_out):
            x.close()
        for end in ("arrow", "docs.arrow"):
            self.fs.move(self._own(end), f"{self.base}/{self.name}.{end}")
        return pa.record_batch(
            [pa.array([int(self.name.split("-")[1])]), pa.array([self.name]), pa.array([self.total]), pa.array([self.places], pa.list_(pa.int64()))],
            ["shard", "name", "n_tokens", "places"])


def write(
    docs: DataFrame, folder: str, tokenizer: str, *, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    length: int = SEQUENCE, kind: str = "<u2",
) -> DataFrame:
    """Write the documents in ascending order of `id_col`; the manifest, which is also stored in the folder.

    `kind` is the stored integer: `<u2` for vocabularies of up to 65,536 ids, else `<u4`.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = pa.int64() if dict(rows.dtypes)["id"] == "bigint" else pa.string()
    if id_type == pa.string():
        rows = rows.withColumn("id", F.col("id").cast("string"))
    end = np.array([end_id], kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, task = None, TaskContext.get()
        for batch in slices(batches):
            if shard is None:
                shard = _Shard(folder, f"shard-{task.partitionId():06d}", str(task.taskAttemptId()), kind, length, id_type)
                known = encoder(tokenizer, kind)
            shard.add(batch.column("id"), known.encode(batch.column("text")), end)
        if shard is not None:
            yield shard.close()

    tie = F.xxhash64("text")
    manifest = (
        rows.repartitionByRange("id", tie).sortWithinPartitions("id", tie)
        .mapInArrow(run, "shard long, name string, n_tokens long, places array<long>"))
    path = f"{folder}/manifest"
    manifest.write.parquet(path)
    return spark.read.schema(manifest.schema).parquet(path)


def batches_of(folder: str, name: str, places: list[int], wanted: range | None = None) -> Iterator[pa.RecordBatch]:
    """Record batches of a shard by their byte offsets; from a local file these are views of the mapped file."""
    fs, base = open_folder(folder)
    path = f"{base}/{name}.arrow"
    file = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
    with file:
        schema = pa.ipc.open_stream(file).schema
        for i in wanted if wanted is not None else range(len(places)):
            file.seek(places[i])
            message = pa.ipc.read_message(file)
            if message.type == "schema":  # stands before the first batch
                message = pa.ipc.read_message(file)
            yield pa.ipc.read_record_batch(message, schema)


def sequence(folder: str, manifest: DataFrame, name: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of one sequence of a shard."""
    places = manifest.where(F.col("name") == name).first()["places"]
    at, within = divmod(number, BATCH_SEQUENCES)
    batch = next(batches_of(folder, name, places, range(at, at + 1)))
    return tuple(batch.column(c)[within].values.to_numpy(zero_copy_only=False) for c in ("input_ids", "mask"))


def documents(spark: SparkSession, folder: str, manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """Per document, from the files: `doc_id`, `start` (ids of all documents before it), `n_tokens`, `ids_crc32`.

    Shards are numbered, so only their counts are summed ahead: two numbers for each task that wrote. The places of
    the batches do not pass the window.
    """
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = manifest.select("shard", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0)).alias("base"))
    arrow_id = pa.int64() if id_type in ("long", "bigint") else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            ids = batches_of(folder, row["name"], row["places"])
            have, at = np.zeros(0, np.uint32), 0
            fs, base = open_folder(folder)
            with pa.ipc.open_stream(fs.open_input_stream(f"{base}/{row['name']}.docs.arrow")) as docs:
                for batch in docs:
                    sums = []
                    for n in batch.column("n_tokens").to_pylist():
                        crc = 0
                        while n:
                            if at == len(have):
                                have, at = next(ids).column("input_ids").flatten().to_numpy().astype("<u4"), 0
                            part = have[at:at + n]
                            crc, at, n = zlib.crc32(part, crc), at + len(part), n - len(part)
                        sums.append(crc)
                    start = batch.column("offset").to_numpy() + row["base"]
                    yield pa.record_batch(
                        [batch.column("doc_id").cast(arrow_id), pa.array(start), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
            ids.close()

    # One row is a whole file: as many tasks as files, which merging small partitions must not undo.
    dealt = manifest.join(before, "shard").repartition(max(1, manifest.count()), F.col("shard")).select("name", "places", "base")
    return dealt.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_and_read(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write documents to the shared folder, read the files back and remove them."""
    spark = docs.sparkSession
    with Work(spark, "token-files") as work:
        folder = work.path("tokens")
        manifest = write(docs, folder, tokenizer, **options)
        id_type = dict(docs.dtypes)[options.get("id_col", "doc_id")]
        return result(documents(spark, folder, manifest, id_type if id_type == "bigint" else "string"))


@query("op1_token_files")
def op1(spark, sf_dir):
    return encode_and_read(table(spark, sf_dir, "documents"), vocabulary(), end_id=2)
