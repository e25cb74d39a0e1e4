"""URL filters: lists of hosts and paths as sorted arrays of digests, which executors map into memory.

An entry is a host and a path, written together (``example.net/en/``). It fits the URLs on its host and on all
subdomains whose path starts with the entry's; an entry without a path fits every path. A list is stored as files of
raw bytes, each of which holds a range of the 64-bit xxhash digests of the entries: the digests in ascending order, the
places of the strings, the verdicts, and the strings themselves. Spark sorts and writes the files and hands them out to
the executors; every task maps them, so that all workers of a machine share the pages and only the pages that are
probed are read. The pages themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campflow.llm.common import free_name, stage

SEED = 42
ALLOW, BLOCK = "allow", "block"
#: Entries of one file. A task holds the entries of one file while it writes it.
FILE_ENTRIES = 1 << 20
#: Lists of more bytes than this are not copied to the executors; their entries are joined with the URLs' own.
MAPPED_BYTES = 16 << 30
_HEAD = 16
_ASCII_UPPER, _ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, number sign or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _ASCII_UPPER, _ASCII_LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, number sign or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


@dataclass(frozen=True)
class UrlList:
    """A stored list: its folder, its files with their sizes, and what bounds the probes of a URL."""

    folder: str
    files: tuple[tuple[str, int], ...]
    path_lengths: tuple[int, ...]
    longest_host: int

    @property
    def size(self) -> int:
        return sum(size for _, size in self.files)


def write_list(entries: DataFrame, folder: str) -> UrlList:
    """Store ``entries`` (entry, verdict) below ``folder``.

    A verdict is ``allow`` or ``block``; null entries are left out, and of an entry with both verdicts ``block`` stays.
    Entries keep their letters: hosts of lists should be in lower case. Every file holds a range of digests, so equal
    digests of different entries lie side by side. The lengths of the entries' paths and the longest host are looked up
    here, because no URL has to be probed beyond them.
    """
    spark = entries.sparkSession
    entry, digest = F.col("entry"), F.xxhash64("entry")
    rows = entries.filter(entry.isNotNull()).groupBy("entry").agg(F.max(F.col("verdict") == BLOCK).alias("block"))
    # the order of signed numbers becomes that of unsigned ones when the first bit changes
    rows = stage(rows.select("entry", F.coalesce("block", F.lit(False)).alias("block"),
                             digest.bitwiseXOR(F.lit(-(1 << 63))).alias("place")), "url_entries")
    path_at = F.instr(entry, "/")
    path_bytes = F.when(path_at == 0, 0).otherwise(F.octet_length(F.expr("substring(entry, instr(entry, '/'))")))
    known = rows.agg(F.count(F.lit(1)).alias("n"), F.collect_set(path_bytes).alias("lengths"),
                     F.max(F.octet_length("entry") - path_bytes).alias("host")).first()
    files = max(1, -(-known.n // FILE_ENTRIES))
    dealt = rows.repartitionByRange(files, "place").sortWithinPartitions("place", "entry")
    packed = dealt.select("entry", "block").mapInArrow(_pack, "file binary")
    # the text writer copies the bytes of a value as they are and adds one line end
    packed.select(F.col("file").cast("string")).write.text(f"{folder}/digests")
    return open_list(spark, folder, known.lengths, known.host)


def open_list(spark: SparkSession, folder: str, lengths: Iterable[int], longest_host: int | None) -> UrlList:
    """A list that :func:`write_list` has stored; its files are listed, not read."""
    found = spark.read.format("binaryFile").load(f"{folder}/digests").select("path", "length").collect()
    files = tuple(sorted((row.path, row.length) for row in found if row.length > _HEAD))
    return UrlList(folder, files, tuple(sorted(lengths)), longest_host or 0)


def digest_of(entry: bytes) -> int:
    return xxhash.xxh64_intdigest(entry, SEED)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    entries: list[bytes] = []
    block: list[bool] = []
    for batch in batches:
        entries += [e.encode() for e in batch.column(0).to_pylist()]
        block += batch.column(1).to_pylist()
    if entries:
        keys = np.fromiter(map(digest_of, entries), "<u8", len(entries))
        ends = np.cumsum([0, *map(len, entries)], dtype="<u8")
        head = np.array([len(entries), 0], "<u8")
        parts = [head.tobytes(), keys.tobytes(), ends.tobytes(), np.array(block, "u1").tobytes(), *entries]
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["file"])


class MappedFile:
    """One file of a list, mapped."""

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view("<u8")[0])
        ends_at, block_at = _HEAD + 8 * n, _HEAD + 16 * n + 8
        self.keys = raw[_HEAD:ends_at].view("<u8")
        self._ends, self._block = raw[ends_at:block_at].view("<u8"), raw[block_at : block_at + n]
        self._strings = raw[block_at + n :]

    def find(self, digests: np.ndarray, entries: Sequence[bytes]) -> Iterator[tuple[int, bool]]:
        """The places of ``entries`` that the file holds, and whether they are blocked.

        All digests are searched at once; equal digests count only where the whole strings are equal too.
        """
        at = np.searchsorted(self.keys, digests)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == digests).tolist():
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == digests[i]:
                if self._strings[int(self._ends[k]) : int(self._ends[k + 1])].tobytes() == entries[i]:
                    yield i, bool(self._block[k])
                    break
                k += 1


class MappedList:
    """All files of a list; every probe goes to the one file whose range it falls in."""

    def __init__(self, paths: Sequence[str]) -> None:
        files = [f for f in map(MappedFile, paths) if len(f.keys)]
        self._files = sorted(files, key=lambda f: int(f.keys[0]))
        self._starts = np.array([f.keys[0] for f in self._files], np.uint64)

    def find(self, entries: Sequence[bytes]) -> Iterator[tuple[int, bool]]:
        if not self._files or not entries:
            return
        digests = np.fromiter(map(digest_of, entries), np.uint64, len(entries))
        owner = np.maximum(np.searchsorted(self._starts, digests, "right") - 1, 0)
        for k in np.unique(owner).tolist():
            mine = np.flatnonzero(owner == k)
            for i, block in self._files[k].find(digests[mine], [entries[j] for j in mine.tolist()]):
                yield int(mine[i]), block


@cache
def _mapped(names: tuple[str, ...]) -> MappedList:
    return MappedList([SparkFiles.get(name) for name in names])


def candidates(host: bytes, path: bytes, lengths: Sequence[int], longest_host: int) -> Iterator[tuple[bytes, int]]:
    """Every entry that would fit a URL, with the bytes of its host: of each parent domain, with each start of the
    path of a length that the list has. Longer hosts than any in the list are passed over."""
    at = 0
    if len(host) > longest_host:  # the first end of the host that is short enough and begins a label
        at = host.find(b".", len(host) - longest_host - 1) + 1 or len(host) + 1
    while at <= len(host):
        end = host[at:]
        for length in lengths:
            if length > len(path):
                break
            yield end + path[:length], len(end)
        dot = host.find(b".", at)
        if dot < 0:
            break
        at = dot + 1


def judged(pages: DataFrame, lists: Sequence[UrlList], mapped_bytes: int = MAPPED_BYTES) -> DataFrame:
    """``page_id, host, path, entry, place, verdict`` for every row of ``pages`` (page_id, url; others are not read).

    Of the entries of a list that fit a URL the longest decides (of equally long ones, that with the longer host); the
    first of ``lists`` that has a fitting entry decides in place of the later ones, and ``place`` is its number. A URL
    that no entry fits has a null ``entry`` and is allowed. A null URL, or one without ``://``, has an empty host and
    path, which only an empty entry fits. Repeated rows are all judged; empty lists and tables are fine.
    """
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if sum(one.size for one in lists) > mapped_bytes:
        return _joined(pages, lists)
    context = pages.sparkSession.sparkContext
    names = []
    for one in lists:
        for file, _ in one.files:
            context.addFile(file)
        names.append(tuple(file.rpartition("/")[2] for file, _ in one.files))
    bounds = [(one.path_lengths, one.longest_host) for one in lists]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = ([t.encode() for t in batch.column(i).to_pylist()] for i in (1, 2))
            best: list[tuple | None] = [None] * batch.num_rows
            for number, (own, (lengths, longest)) in enumerate(zip(names, bounds)):
                rows, probes, host_bytes = [], [], []
                for row, (host, path) in enumerate(zip(hosts, paths)):
                    if best[row] is None:
                        for entry, n in candidates(host, path, lengths, longest):
                            rows.append(row)
                            probes.append(entry)
                            host_bytes.append(n)
                for i, block in _mapped(own).find(probes):
                    rank = (len(probes[i]), host_bytes[i], probes[i], number, block)
                    if best[rows[i]] is None or best[rows[i]] < rank:
                        best[rows[i]] = rank
            found = [(None, None, ALLOW) if b is None else (b[2].decode(), b[3], BLOCK if b[4] else ALLOW) for b in best]
            entry, place, verdict = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(entry, pa.string()), pa.array(place, pa.int32()), pa.array(verdict, pa.string())],
                ["page_id", "host", "path", "entry", "place", "verdict"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(run, f"page_id {kind}, host string, path string, entry string, place int, verdict string")


def _joined(pages: DataFrame, lists: Sequence[UrlList]) -> DataFrame:
    """The same for lists that are too large to copy: the candidates of all different hosts and paths meet the entries
    in a join on digest and string."""
    spark = pages.sparkSession
    sites, best = pages.select("host", "path").distinct(), None
    for number, one in enumerate(lists):
        lengths, longest = one.path_lengths, one.longest_host

        def run(batches: Iterator[pa.RecordBatch], lengths=lengths, longest=longest) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for host, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    found = list(candidates(host.encode(), path.encode(), lengths, longest))
                    texts, sizes = [_whole(entry) for entry, _ in found], [size for _, size in found]
                    arrays = [pa.array([host] * len(found), pa.string()), pa.array([path] * len(found), pa.string()),
                              pa.array(texts, pa.string()), pa.array(sizes, pa.int32())]
                    yield pa.RecordBatch.from_arrays(arrays, ["host", "path", "entry", "host_bytes"])

        probes = sites.mapInArrow(run, "host string, path string, entry string, host_bytes int")
        hits = probes.withColumn("digest", F.xxhash64("entry")).join(_entries(spark, one), ["digest", "entry"])
        rank = F.struct(F.lit(-number).alias("first"), F.octet_length("entry").alias("size"), "host_bytes", "entry", "block")
        own = hits.select("host", "path", rank.alias("rank"))
        best = own if best is None else best.unionByName(own)
    if best is None:
        best = sites.select("host", "path", F.lit(None).cast("struct<first int, entry string, block boolean>").alias("rank")).limit(0)
    best = best.groupBy("host", "path").agg(F.max("rank").alias("rank"))
    verdict = F.when(F.col("rank.block"), BLOCK).otherwise(ALLOW)
    return pages.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("rank.entry").alias("entry"), (-F.col("rank.first")).alias("place"), verdict.alias("verdict")
    )


def _whole(entry: bytes) -> str | None:
    """Null for bytes that a length of the list has cut inside a character: no entry is like that."""
    try:
        return entry.decode()
    except UnicodeDecodeError:
        return None


def _entries(spark: SparkSession, one: UrlList) -> DataFrame:
    """The entries of a stored list as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                raw = np.frombuffer(file, np.uint8)
                n = int(raw[:8].view("<u8")[0])
                ends = raw[_HEAD + 8 * n : _HEAD + 16 * n + 8].view("<u8").tolist()
                block, strings = raw[_HEAD + 16 * n + 8 : _HEAD + 17 * n + 8], file[_HEAD + 17 * n + 8 :]
                entries = [strings[a:b].decode() for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(entries), pa.array(block.astype(bool))], ["entry", "block"])

    files = spark.read.format("binaryFile").load(f"{one.folder}/digests").filter(F.col("length") > _HEAD).select("content")
    return files.mapInArrow(run, "entry string, block boolean").withColumn("digest", F.xxhash64("entry"))


def filtered(pages: DataFrame, lists: Sequence[UrlList]) -> DataFrame:
    """The rows of ``pages``, with all their columns, whose URL is allowed.

    Rows are matched by URL, so rows without a page_id, or with one that repeats, are judged too.
    """
    url, own = F.col("url"), free_name(pages, "_url")
    urls = pages.select(url.alias("page_id"), url).distinct()
    blocked = judged(urls, lists).filter(F.col("verdict") == BLOCK).select(F.col("page_id").alias(own))
    return pages.join(blocked, url.eqNullSafe(F.col(own)), "left_anti")


def listed_hosts(pages: DataFrame, words: Sequence[str]) -> DataFrame:
    """``entry, verdict``: every host of ``pages`` one of whose labels has one of ``words`` as a whole part.

    Parts of a label are divided by hyphens. The hosts are blocked with all their paths and subdomains.
    """
    host = host_of(F.col("url"))
    hosts = pages.select(host.alias("entry")).distinct()
    return hosts.filter(F.arrays_overlap(F.split("entry", "[.-]"), F.array(*map(F.lit, words)))).withColumn("verdict", F.lit(BLOCK))
