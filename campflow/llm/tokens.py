"""Token ids in block files: every document its own zstandard frame under one shared, trained dictionary.

A folder of token files holds three Parquet tables, so that Spark's writers commit them on any file system:

* ``dictionary``: one row with the dictionary, its hash, the tokenizer, the end id and the bytes per id.
* ``blocks``: runs of documents in ascending doc_id. ``payload`` is their frames one after the other; ``doc_ids``,
  ``starts``, ``n_tokens`` and ``offsets`` are the index, so one document is read by unpacking its frame alone.
  Every block names the hash of the dictionary it needs.
* ``parts``: the number of ids before each part of the blocks; with the starts inside a part it gives global places.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from campflow.llm.common import giving_back, utf8_texts

END_ID = 1
#: The dictionary is trained on so many documents, drawn by a hash of doc_id over the whole table, and on so many
#: bytes of each one's ids.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 1 << 13, 1 << 16
_LEVEL, _BLOCK_BYTES, _BLOCK_DOCS = 3, 1 << 20, 4096
#: So many forms are at hand in a worker, and so many times as many packed.
_CACHED_FORMS, _PACKED = 250_000, 3
_GROUP_BYTES = 2 << 20
#: Characters that normal forms, lower-casing or white space rules may treat together with others: all but ASCII white
#: space and the printable characters of ASCII and Latin.
_MOVED = re.compile("[^\\t-\\r\\x20-\\x7e\u00a1-\u012f\u0131-\u024f]")
#: The tokenizer takes all signs that follow a letter or digit, up to white space, as a piece of its own. Apostrophes are
#: not among these: it knows some endings by them.
_SIGNS = re.compile(r"[.,#$%&*](?<=[^\W_].)[.,#$%&*]*(?!\S)")
_BLOCK_SCHEMA = (
    "part int, block int, first_id long, last_id long, n_ids long, dict_hash string, doc_ids array<long>,"
    " starts array<long>, n_tokens array<long>, offsets array<long>, payload binary"
)


def _strings(column: pa.Array) -> list[str]:
    """The values of a column of strings without line ends; several times as fast as ``to_pylist``."""
    if not len(column):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
    return pc.binary_join(whole, pa.scalar("\n", column.type))[0].as_py().split("\n")


def _bytes(column: pa.Array) -> list[bytes]:
    """The same of a column of large binaries that begins with its buffers."""
    if not len(column):
        return []
    cuts, raw = np.frombuffer(column.buffers()[1], np.int64)[: len(column) + 1].tolist(), bytes(column.buffers()[2] or b"")
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


class _Packed:
    """Forms and their ids in Arrow columns, found by hash and compared: a fifth of what a dict of them takes."""

    def __init__(self, known: dict[str, bytes]) -> None:
        hashes = np.fromiter(map(hash, known), np.int64, len(known))
        self._rows = np.argsort(hashes).astype(np.int32)
        self._hashes = hashes[self._rows]
        self._forms, self._ids = pa.array(list(known), pa.large_string()), pa.array(list(known.values()), pa.large_binary())

    def known(self, forms: list[str]) -> dict[str, bytes]:
        """Those of ``forms`` that are held, with their ids."""
        asked = np.fromiter(map(hash, forms), np.int64, len(forms))
        places = np.searchsorted(self._hashes, asked).clip(max=len(self._hashes) - 1)
        hits = np.flatnonzero(self._hashes[places] == asked)
        rows = self._rows[places[hits]]
        held = zip(hits.tolist(), _strings(self._forms.take(rows)), _bytes(self._ids.take(rows)))
        return {form: ids for at, form, ids in held if form == forms[at]}


class PieceIds(dict):
    """Ids (as bytes) of the forms of pieces between white space.

    The tokenizer drops white space and never joins over it, so a text's ids are those of its pieces. It lower-cases, and
    splits signs from the letter or digit before them; done beforehand for a whole text, that leaves far fewer forms to
    know. Arrow numbers the different forms of a group of texts, so that each is looked up once, and puts their ids
    together. The unknown forms of a group are encoded in one call, as lines of one text, and told apart by their
    places. Texts with characters that the tokenizer might treat together with their neighbours are encoded as they are.
    When it holds ``_CACHED_FORMS`` forms they are packed, as the newest of ``_PACKED`` generations: forms that are still
    in use come back from there, others go with the oldest.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._older: list[_Packed] = []
        self.kind = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def of(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each text."""
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text.decode())
            size += len(text)
            if size >= _GROUP_BYTES:
                yield from self._ids(group)
                group, size = [], 0
        yield from self._ids(group)

    def _ids(self, group: list[str]) -> list[bytes]:
        out: list[bytes] = []
        plain: list[str] = []
        for text in group:
            if moved := _MOVED.search(text):
                out.append(np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes())
            else:
                out.append(b"")
            plain.append("" if moved else _SIGNS.sub(r" \g<0>", text.lower()))
        words = pc.ascii_split_whitespace(pa.array(plain, pa.large_string()))
        numbered = words.values.dictionary_encode()
        ids = pa.array(self._known(_strings(numbered.dictionary)), pa.large_binary()).take(numbered.indices)
        begins = np.frombuffer(ids.buffers()[1], np.int64) if len(ids) else np.zeros(1, np.int64)
        cuts, raw = begins[words.offsets.to_numpy()].tolist(), memoryview(ids.buffers()[2] or b"")
        return [found or bytes(raw[a:b]) for found, a, b in zip(out, cuts, cuts[1:])]

    def _known(self, forms: list[str]) -> list[bytes]:
        """The ids of different forms."""
        if len(self) >= _CACHED_FORMS:
            self._older = [_Packed(self), *self._older[: _PACKED - 1]]
            self.clear()
        self[""] = b""  # where a text begins or ends with white space
        if unknown := [form for form in forms if form not in self]:
            self._learn(unknown)
        return list(map(self.__getitem__, forms))

    def _learn(self, forms: list[str]) -> None:
        for older in self._older:
            held = older.known(forms)
            self.update(held)
            forms = [form for form in forms if form not in held]
        if not forms:
            return
        found = self._tokenizer.encode("\n".join(forms), add_special_tokens=False)
        ids = np.array(found.ids, self.kind)
        begins = np.fromiter((at for at, _ in found.offsets), np.int64, len(ids))
        cuts = np.searchsorted(begins, np.cumsum([0, *(len(form) + 1 for form in forms)])) * ids.itemsize
        raw, cuts = ids.tobytes(), cuts.tolist()
        self.update((form, raw[a:b]) for form, a, b in zip(forms, cuts, cuts[1:]))


@cache
def _pieces(path: str) -> PieceIds:
    return PieceIds(path)


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A dictionary from the ids of sampled documents; few documents give a plain one, none an empty one."""
    n = docs.count()
    draw = F.xxhash64("doc_id")
    drawn = docs.filter(F.pmod(draw, F.lit(max(n, 1))) < 2 * SAMPLE_DOCS).orderBy(draw, "text").limit(SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(tokenizer)
        for batch in batches:
            out = []
            for ids in pieces.of(utf8_texts(batch.column(0))):
                spare = max(0, len(ids) - SAMPLE_BYTES) // pieces.kind.itemsize
                at = int.from_bytes(hashlib.md5(ids).digest()[:8], "little") % (spare + 1) * pieces.kind.itemsize
                out.append(ids[at : at + SAMPLE_BYTES])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    samples = [bytes(row.ids) for row in drawn.select("text").mapInArrow(giving_back(run), "ids binary").collect() if row.ids]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few to train on
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the ids of all ``docs`` (doc_id, text) to ``folder``, in ascending doc_id; ``end_id`` ends each document.

    Null text is empty. Rows without a doc_id come first; rows that repeat one are all written, in the order of a hash
    of the text. ``tokenizer`` is a file of the tokenizers library that every executor can open under this path.
    The rows are dealt by ranges of doc_id and encoded as a stream, a block at a time.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    raw = train_dictionary(docs, tokenizer)
    name = hashlib.sha256(raw).hexdigest()
    width = _pieces(tokenizer).kind.itemsize
    schema = "dict_hash string, dictionary binary, tokenizer string, end_id int, id_bytes int"
    row = (name, bytearray(raw), tokenizer.rpartition("/")[2], end_id, width)
    spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{folder}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, part = _pieces(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], pieces.kind).tobytes()
        shared = _dictionary(raw)
        pack = zstandard.ZstdCompressor(level=_LEVEL, dict_data=shared) if shared else zstandard.ZstdCompressor(_LEVEL)
        start, block, frames, index, size = 0, 0, [], [], 0

        def full() -> pa.RecordBatch:
            ids, starts, counts, offsets = map(list, zip(*index))
            known = [i for i in ids if i is not None]
            values = [part, block, known[0] if known else None, known[-1] if known else None, sum(counts), name,
                      ids, starts, counts, [*offsets, size], b"".join(frames)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 4,
                     pa.binary()]
            names = [c.split()[0] for c in _BLOCK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), pieces.of(utf8_texts(batch.column(1)))):
                ids += end
                n = len(ids) // pieces.kind.itemsize
                index.append((doc_id, start, n, size))
                frames.append(pack.compress(ids))
                start, size = start + n, size + len(frames[-1])
                if size >= _BLOCK_BYTES or len(frames) >= _BLOCK_DOCS:
                    yield full()
                    block, frames, index, size = block + 1, [], [], 0
        if frames:
            yield full()

    tie = docs.withColumn("tie", F.xxhash64("text"))
    dealt = tie.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    dealt.select("doc_id", "text").mapInArrow(giving_back(run), _BLOCK_SCHEMA).write.parquet(f"{folder}/blocks")
    sums = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = F.sum("n_ids").over(Window.orderBy("part")) - F.col("n_ids")  # a row per task of the writing
    sums.select("part", "n_ids", before.alias("base")).coalesce(1).write.parquet(f"{folder}/parts")


def _frames(spark: SparkSession, folder: str):
    """A function that unpacks a frame under the folder's dictionary to ids as little-endian unsigned 32-bit."""
    head = spark.read.parquet(f"{folder}/dictionary").first()
    raw, name, width = bytes(head.dictionary), head.dict_hash, head.id_bytes
    if hashlib.sha256(raw).hexdigest() != name:
        raise ValueError(f"the dictionary in {folder} is not the one its hash names")
    unpackers: list[zstandard.ZstdDecompressor] = []

    def unpack(frame: bytes, needs: str) -> bytes:
        if needs != name:
            raise ValueError(f"a block needs dictionary {needs}, the folder has {name}")
        if not unpackers:
            shared = _dictionary(raw)
            unpackers.append(zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor())
        return np.frombuffer(unpackers[0].decompress(frame), f"<u{width}").astype("<u4").tobytes()

    return unpack


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in ``folder``.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian unsigned 32-bit integers.
    """
    unpack = _frames(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                cut, payload = row["offsets"], row["payload"]
                ids = [unpack(payload[a:b], row["dict_hash"]) for a, b in zip(cut, cut[1:])]
                arrays = [pa.array([row["part"]] * len(ids), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                          pa.array(row["starts"], pa.int64()), pa.array(row["n_tokens"], pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "doc_id", "start", "n_tokens", "ids"])

    blocks = spark.read.parquet(f"{folder}/blocks").select("part", "doc_ids", "starts", "n_tokens", "offsets", "dict_hash", "payload")
    rows = blocks.mapInArrow(giving_back(run), "part int, doc_id long, start long, n_tokens long, ids binary")
    parts = spark.read.parquet(f"{folder}/parts").select("part", "base")
    return rows.join(parts, "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (of each row with its doc_id), unpacking its frames only."""
    unpack = _frames(spark, folder)
    found = spark.read.parquet(f"{folder}/blocks").filter(F.lit(doc_id).between(F.col("first_id"), F.col("last_id")))
    one = F.explode(F.arrays_zip("doc_ids", F.col("offsets"), F.slice("offsets", 2, F.size("offsets") - 1).alias("ends")))
    hits = found.select("dict_hash", "payload", one.alias("d")).filter(F.col("d.doc_ids") == doc_id)
    frames = hits.select("dict_hash", F.expr("substring(payload, int(d.offsets) + 1, int(d.ends - d.offsets))").alias("frame"))
    return [np.frombuffer(unpack(bytes(r.frame), r.dict_hash), "<u4").tolist() for r in frames.collect()]
