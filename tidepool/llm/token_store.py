"""Token ids of a corpus in shards, each one a wavelet matrix.

Documents are dealt by ranges of their id, encoded there, and written in order:
each task fills shards of about ``SHARD`` ids (a document is never divided) and
writes them as the rows of one Parquet file: ``part`` and ``seq`` (order of the
shards), ``n`` ids of ``width`` bits, ``doc_ids`` and ``lengths`` of its
documents, and ``planes`` and ``ranks``, the bit-planes of the matrix and their
directories (``wavelet.py``), compressed by Parquet.  A second table, ``index``,
gives each shard's ``start``, the number of ids before it.  Everything is
written and read by Spark, so the store may lie wherever Spark can write.

``documents`` reads all ids back, ``access`` the ids at given places, ``count``
and ``locate`` the occurrences of given ids; the last three use rank and select
and unpack no plane.

Encoding is the tokenizers library's (byte-level BPE, its special tokens found
in a text become their ids).  Texts are cut into the pieces of its pattern in
numpy, by character classes that the library itself gave (``charclass.py``); its
model encodes each distinct piece once, and a Python worker remembers pieces up
to ``REMEMBERED`` characters and then starts afresh.

Defined results: null text is the empty text, which has the end id alone; a null
id comes first; rows of one id are ordered by a hash of their text, repeated
rows are documents of their own, and a hot id is dealt to several tasks; a text
of any length is encoded whole and its shard is as long as it has to be; other
columns are ignored; an empty table has no shards and no documents.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.bpe import byte_chars
from tidepool.llm.charclass import END, byte_kinds, class_table, cut
from tidepool.llm.textvec import pieces as pieces_of
from tidepool.llm.textvec import power_table  # noqa: F401  a test sets it here
from tidepool.llm.wavelet import WaveletMatrix

#: Ids of a shard, and bytes of remembered pieces.
SHARD = 1 << 20
REMEMBERED = 1 << 23
#: Characters that are cut and looked up at once (a longer text is a group of its own).
AT_ONCE = 1 << 22
#: Global places that share a key when places are matched with shards.
STRIDE = 1 << 20

SHARD_SCHEMA = ("part int, seq int, n bigint, width int, doc_ids array<bigint>, lengths array<bigint>, "
                "planes binary, ranks binary")


def _places(n: int, shift: np.ndarray, size: np.ndarray) -> np.ndarray:
    """0 to n - 1, runs of the given sizes each moved by its shift."""
    kind = np.int32 if n < 1 << 30 else np.int64
    return np.arange(n, dtype=kind) + np.repeat(shift.astype(kind), size)


def _distinct(raw: bytes, start: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(distinct pieces of ``raw``, which of them each piece is); a piece ends where the next one starts."""
    kind, offset = (pa.binary(), np.int32) if len(raw) < 1 << 31 else (pa.large_binary(), np.int64)
    bounds = pa.py_buffer(np.append(start, len(raw)).astype(offset))
    found = pa.Array.from_buffers(kind, len(start), [None, bounds, pa.py_buffer(raw)]).dictionary_encode()
    _, bounds, data = found.dictionary.buffers()
    at, data = np.frombuffer(bounds, offset)[:len(found.dictionary) + 1].tolist(), data.to_pybytes()
    return [data[a:b] for a, b in zip(at, at[1:])], found.indices.to_numpy()


#: Encoders of this Python worker, by vocabulary.
_encoders: dict[str, Callable[[list[str]], list[bytes]]] = {}


class ByteBpe:
    """A byte-level BPE file: its pieces by the library's classes, their ids by its model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = f.read()
        spec = json.loads(self.spec)
        cut = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or (cut["type"], cut["add_prefix_space"], cut["use_regex"]) != ("ByteLevel", False, True):
            raise ValueError(f"{path} is not a byte-level BPE file without normalizer")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.width = max(1, max([*spec["model"]["vocab"].values(), *self.special.values()]).bit_length())
        self.table = class_table()

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without special tokens."""
        raw = text.encode()
        points = np.frombuffer(raw, dtype=np.uint8)
        at = cut(points, byte_kinds(points, self.table)).tolist() if text else []
        return [raw[a:b].decode() for a, b in zip(at, [*at[1:], len(raw)])]

    def encoder(self) -> Callable[[list[str]], list[bytes]]:
        """texts -> their ids as little-endian 32-bit integers; one for each Python worker."""
        key = hashlib.sha256(self.spec.encode()).hexdigest()
        if key not in _encoders:
            _encoders[key] = self._encoder()
        return _encoders[key]

    def _encoder(self) -> Callable[[list[str]], list[bytes]]:
        from tokenizers import Tokenizer

        model, table = Tokenizer.from_str(self.spec).model, self.table
        model._resize_cache(0)  # every piece is new to it
        marks = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        special, letters = tuple(self.special), byte_chars()
        known: dict[bytes, bytes] = {}
        older: dict[bytes, bytes] = {}
        held = 0

        def ids_of(piece: bytes) -> bytes:
            if piece.isascii() and (text := piece.decode()).isprintable():
                shown = text.replace(" ", letters[0x20])
            else:
                shown = "".join(map(letters.__getitem__, piece))
            return array("I", [t.id for t in model.tokenize(shown)]).tobytes()

        def together(texts: list[str]) -> list[bytes]:
            """Texts without special tokens: equal pieces are found by Arrow, each is looked up once."""
            nonlocal known, older, held
            raw = [t.encode() for t in texts]
            ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1) - 1
            raw = b"\n".join([*raw, b""])
            points = np.frombuffer(raw, dtype=np.uint8)
            kinds = byte_kinds(points, table)
            kinds[ends] = END
            start = cut(points, kinds)
            words, which = _distinct(raw, start)
            ids = list(map(known.get, words))
            for k, found in enumerate(ids):
                if found is None:
                    if held > REMEMBERED // 2:
                        known, older, held = {}, known, 0
                    ids[k] = known[words[k]] = older.get(words[k]) or ids_of(words[k])
                    held += len(words[k])
            flat = np.frombuffer(b"".join(ids), dtype="<u4")
            count = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            first = np.cumsum(count) - count
            mine = count[which]
            last = np.searchsorted(start, ends)  # the piece that ends each text
            mine[last] = 0
            place = np.cumsum(mine)
            out = flat[_places(int(place[-1]), first[which] - (place - mine), mine)].tobytes()
            at = [0, *(4 * place[last]).tolist()]
            return [out[x:y] for x, y in zip(at, at[1:])]

        def encode(texts: list[str]) -> list[bytes]:
            # a text with special tokens is the texts between them
            parts = [(marks.split(t), marks.findall(t)) if any(s in t for s in special) else ([t], ()) for t in texts]
            found = chain.from_iterable(together(group) for _, group in pieces_of([x for plain, _ in parts for x in plain], AT_ONCE))
            out = []
            for plain, between in parts:
                ids = next(found)
                if between:
                    ids += b"".join([self.special[m].to_bytes(4, "little") + next(found) for m in between])
                out.append(ids)
            return out

        return encode


def _shards(docs: DataFrame, tokenizer: ByteBpe, end: int, width: int, size: int) -> DataFrame:
    """``docs`` (doc_id, text), in order within and across partitions, as shard rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail, part, seq = tokenizer.encoder(), end.to_bytes(4, "little"), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def shard() -> pa.RecordBatch:
            nonlocal seq, held, ids, texts
            found = np.frombuffer(b"".join(texts), dtype="<u4")
            planes, ranks = WaveletMatrix.of(found, width).to_bytes()
            row = [part], [seq], [len(found)], [width], [ids], [[len(t) // 4 for t in texts]], [planes], [ranks]
            types = pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()
            seq, held, ids, texts = seq + 1, 0, [], []
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)],
                                              names=[f.split()[0] for f in SHARD_SCHEMA.split(", ")])

        for b in batches:
            for doc_id, found in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist()), strict=True):
                ids.append(doc_id)
                texts.append(found + tail)
                held += len(texts[-1]) // 4
                if held >= size:
                    yield shard()
        if ids:
            yield shard()

    return docs.mapInArrow(run, SHARD_SCHEMA)


def write(docs: DataFrame, path: str, tokenizer: ByteBpe, end: int, text: str = "text", id_col: str = "doc_id", size: int = SHARD) -> None:
    """Write the ids of ``docs``, each document's followed by ``end``, in ascending id order."""
    spark = docs.sparkSession
    width = max(tokenizer.width, end.bit_length())
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # ties: by text; the row's place only deals equal rows to several tasks
    rows = rows.withColumns({"__h": F.xxhash64("text"), "__at": F.monotonically_increasing_id()})
    order = ["doc_id", "__h", "__at"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    _shards(placed, tokenizer, end, width, size).write.option("compression", "zstd").parquet(f"{path}/shards")
    n = spark.read.parquet(f"{path}/shards").select("part", "seq", "n")
    # one row a task is summed along the order of tasks; shards only within their task
    parts = n.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    index = (n.withColumn("__inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, "part")
             .select("part", "seq", "n", (F.col("__before") + F.col("__inside")).alias("start")))
    index.write.parquet(f"{path}/index")


def _read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards"),
            spark.read.schema("part int, seq int, n bigint, start bigint").parquet(f"{path}/index"))


def _rows(b: pa.RecordBatch) -> Iterator[tuple[dict, WaveletMatrix]]:
    for r in b.to_pylist():
        yield r, WaveletMatrix.from_bytes(r["planes"], r["ranks"], r["n"], r["width"])


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary): every document, its ids as little-endian 32-bit integers."""
    return _documents(spark, path, "ids binary", lambda ids: ids, pa.binary())


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document."""
    return _documents(spark, path, "ids_crc32 bigint", zlib.crc32, pa.int64())


def _documents(spark: SparkSession, path: str, field: str, of, kind: pa.DataType) -> DataFrame:
    shards, index = _read(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, matrix in _rows(b):
                ids = matrix.ids().astype("<u4").tobytes()
                at = [0, *accumulate(r["lengths"])]
                k = len(at) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"]] * k, pa.int32()), pa.array([r["seq"]] * k, pa.int32()), pa.array(r["doc_ids"], pa.int64()),
                     pa.array(at[:-1], pa.int64()), pa.array(r["lengths"], pa.int64()),
                     pa.array([of(ids[4 * x:4 * y]) for x, y in zip(at, at[1:])], kind)],
                    names=["part", "seq", "doc_id", "__local", "n_tokens", field.split()[0]])

    found = shards.mapInArrow(run, f"part int, seq int, doc_id bigint, __local bigint, n_tokens bigint, {field}")
    return (found.join(index.drop("n"), ["part", "seq"])
            .select("doc_id", (F.col("start") + F.col("__local")).alias("start"), "n_tokens", field.split()[0]))


def access(spark: SparkSession, path: str, places: DataFrame, col: str = "pos") -> DataFrame:
    """(pos, id) of every distinct place of the corpus in ``places``; places it has not are left out."""
    shards, index = _read(spark, path)
    ends = index.withColumn("__key", F.explode(F.sequence(F.expr(f"start div {STRIDE}"), F.expr(f"(start + n - 1) div {STRIDE}"))))
    wanted = places.select(F.col(col).cast("bigint").alias("pos")).where("pos >= 0").distinct().withColumn("__key", F.expr(f"pos div {STRIDE}"))
    at = wanted.join(ends, "__key").where("pos >= start AND pos < start + n")
    asked = at.groupBy("part", "seq", "start").agg(F.collect_list(F.col("pos") - F.col("start")).alias("at"))  # at most n of a shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, matrix in _rows(b):
                local = np.array(r["at"], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(local + r["start"]), pa.array(matrix.access(local))], names=["pos", "id"])

    return shards.drop("doc_ids", "lengths").join(asked, ["part", "seq"]).mapInArrow(run, "pos bigint, id bigint")


def count(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """(id, n) of each of ``ids``: two ranks on every plane of a shard."""
    shards, _ = _read(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(ids, 0)
        for b in batches:
            for _, matrix in _rows(b):
                for i in total:
                    total[i] += matrix.rank(i)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["id", "n"])

    zero = spark.createDataFrame([(i, 0) for i in dict.fromkeys(ids)], "id bigint, n bigint")
    found = shards.drop("doc_ids", "lengths").mapInArrow(run, "id bigint, n bigint")
    return found.unionByName(zero).groupBy("id").agg(F.sum("n").alias("n"))


def locate(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """(id, pos) of every occurrence of ``ids`` in the corpus: one select on every plane for each."""
    shards, index = _read(spark, path)
    wanted = list(dict.fromkeys(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, matrix in _rows(b):
                for i in wanted:
                    at = matrix.places(i)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r["part"], np.int32)), pa.array(np.full(len(at), r["seq"], np.int32)),
                                                      pa.array(np.full(len(at), i, np.int64)), pa.array(at)], names=["part", "seq", "id", "__local"])

    found = shards.drop("doc_ids", "lengths").mapInArrow(run, "part int, seq int, id bigint, __local bigint")
    return found.join(index.drop("n"), ["part", "seq"]).select("id", (F.col("start") + F.col("__local")).alias("pos"))
