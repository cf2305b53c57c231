"""Token-ID files with a minimal perfect hash index.

A written folder holds

* ``ids/``: shard files of raw token ids, nothing else: little-endian unsigned
  16-bit integers, or 32-bit where the vocabulary needs it, documents in
  ascending order of their key, each ended by the end id;
* ``keys``: a Parquet row for each document: key, copy (0, 1, ... among rows
  with one key, in file order), shard, offset and n in ids;
* ``shards``: a Parquet row for each shard: file, first (ids in all shards before
  it), and how its first key goes on from the shard before;
* ``index``: a Parquet row for each bucket of the hash index.

The index maps (key, copy) to shard and offset. Keys are dealt into buckets of
about ``BUCKET`` keys by one hash; inside a bucket, groups of about two keys get
displacements (largest group first) so that all n keys land on n slots without
a gap. Each slot keeps the key's 64-bit fingerprint, shard, offset and length;
a lookup reads one displacement and one slot, and a wrong fingerprint means
that the key is not there. The keys themselves are not in the index.

Files are written by tasks under names of their own attempt and come to count
only by the rows that Spark commits for the attempt that succeeded, so a lost
executor leaves at most a file that nothing refers to. The folder must be
reachable from all executors; it is opened through ``pyarrow.fs``.

Defined results: a null text is encoded as empty and is just the end id; null keys
come first and are looked up like others; rows with one key are kept in the order
of a hash of their text, and are told apart by ``copy``; an empty table has no
shards and finds nothing; strings of special tokens in a text become those tokens,
as by a plain ``encode``.
"""

from __future__ import annotations

import math
import os
import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from commitlake.llm.common import mix64, release, runs

SHARD_BYTES = 32_000_000
BUCKET = 1024
#: Tokens of the splitter (some 40 bytes each) that an encoder remembers at most.
KNOWN = 250_000
#: Tokens of the splitter that are merged in one call.
_MERGED = 64
#: White space, as a class of Arrow's expressions (whose own \\s is ASCII's, without \\v).
_WHITE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of output that a task holds at once.
_HELD = 4_000_000
#: The split pattern of byte-level BPE (a fixed, public value).
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_characters() -> np.ndarray:
    """Byte-level BPE's characters for bytes: printable Latin-1 characters stand
    for themselves, the other bytes for the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    characters = np.arange(256, dtype="<u4")
    characters[others] = 256 + np.arange(len(others))
    return characters


_BYTE_CHARS = _byte_characters()


def _byte_kinds() -> np.ndarray:
    """What a byte is to the splitter: a letter (ASCII's, and U+00C0 to U+00FF), a digit, white
    space, another sign, or none of these surely (an apostrophe can begin a token like 's)."""
    kinds = np.full(256, 4, np.uint8)
    kinds[:128] = [0 if chr(b).isalpha() else 1 if chr(b).isdigit() else 2 if b in b" \t\n\v\f\r" else 3 for b in range(128)]
    kinds[[39, *range(0x1C, 0x20)]] = 4
    kinds[[*range(0x80, 0xC0), 0xC3]] = 0
    return kinds


_KINDS = _byte_kinds()


def _laid(ids: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists that ``codes`` name, in a row, and their ends; lists lie in ``ids`` up to ``ends``."""
    sizes = np.diff(ends, prepend=0)
    n = sizes[codes]
    at = np.cumsum(n)
    return ids[np.repeat((ends - sizes)[codes] - at + n, n) + np.arange(at[-1] if len(at) else 0)], at


def _bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in a row, and the n + 1 edges."""
    _, edges, data = texts.buffers()
    edges = np.frombuffer(edges, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data else np.empty(0, np.uint8)
    return raw, edges - edges[0]


class Encoder:
    """Token ids of whole texts by the tokenizers library, as arrays.

    A byte-level tokenizer splits a text before it merges, so what is between
    two splits always has the same ids: texts are cut at spaces, the different pieces
    into the splitter's tokens, and each different token is merged once. The ids of
    ``known`` tokens at most are remembered. Texts in which
    a space stands before other white space, or a special token's string, and
    all texts of other kinds of tokenizers, are encoded as a whole.
    """

    def __init__(self, file: str, end_id: int, known: int = KNOWN):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(file)
        before = self.tokenizer.pre_tokenizer
        self.splits = (
            isinstance(before, ByteLevel) and before.use_regex and not before.add_prefix_space and not self.tokenizer.normalizer
        )
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([f" [{_WHITE}]", r"\x00", *(re.sub(r"(\W)", r"\\\1", s) for s in specials)])
        self.find = regex.compile(_SPLIT).findall
        model = self.tokenizer.model
        self.merge = model.tokenize
        self.kind = id_type(self.tokenizer.get_vocab_size(), end_id)
        self.end = end_id
        # a character that is in no other token merges with nothing: what it parts can be merged in one call
        nul = chr(_BYTE_CHARS[0])
        other = (getattr(model, a, None) for a in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        apart = self.splits and not any(other) and not any(nul in t for t in self.tokenizer.get_vocab() if t != nul)
        self.nul = model.token_to_id(nul) if apart else None
        self.most = known
        self.known, self.ids, self.ends = pa.array([], pa.string()), np.empty(0, self.kind), np.empty(0, np.int64)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Raw ids of each text, the end id last."""
        ids, n = self.encode_array(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(n)[:-1])] if texts else []

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each text's end id last, and their number by text."""
        if not len(texts):
            return np.empty(0, self.kind), np.empty(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.string()), "")
        whole = pc.match_substring_regex(texts, self.whole) if self.splits else pa.array(np.ones(len(texts), bool))
        # a text without a space is one piece, an empty one too
        lists = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        starts = lists.offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        pieces = lists.flatten()
        words = pieces.dictionary_encode()
        # a space stands before all pieces but a text's first
        spaced = pc.binary_join_element_wise("", words.dictionary, " ")
        codes = words.indices.to_numpy().astype(np.int64)
        codes[starts[:-1]] = len(spaced) + np.arange(len(texts))
        ids, ends = self._pieces(pa.concat_arrays([spaced, pieces.take(pa.array(starts[:-1]))]))
        more = []
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            codes[starts[i]] = len(ends) + len(more)
            more.append(np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, self.kind))
        more.append(np.array([self.end], self.kind))
        codes = np.insert(codes, starts[1:], len(ends) + len(more) - 1)
        ends = np.concatenate([ends, len(ids) + np.cumsum([len(x) for x in more])])
        ids, ends = _laid(np.concatenate([ids, *more]), ends, codes)
        return ids, np.diff(ends[starts[1:] + np.arange(len(texts))], prepend=0)

    def _pieces(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, in a row, and their ends: of the splitter's tokens, each by the merges alone.

        No space is in a piece but before it, and no other white space after that."""
        raw, edges = _bytes(pieces)
        kinds, first = _KINDS[raw], edges[:-1][edges[1:] > edges[:-1]]
        begins = np.ones(len(raw), bool)
        begins[1:] = kinds[1:] != kinds[:-1]
        begins[first] = True
        space = first[raw[first] == 32]
        begins[space[(space + 1 < len(raw)) & ~np.isin(space + 1, first)] + 1] = False
        # the rest by the splitter's own pattern: runs of white space, other letters and signs
        unsure = kinds == 4
        unsure[1:] |= (kinds[1:] == 2) & (kinds[:-1] == 2) | (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
        for i in np.unique(np.searchsorted(edges, np.flatnonzero(unsure), side="right") - 1).tolist():
            at = edges[i]
            begins[at : edges[i + 1]] = False
            for token in self.find(pieces[i].as_py()):
                begins[at] = True
                at += len(token.encode())
        begin = np.flatnonzero(begins)
        at = np.append(begin, len(raw)).astype(np.int32)
        tokens = pa.StringArray.from_buffers(len(begin), pa.py_buffer(at), pa.py_buffer(raw)).dictionary_encode()
        ids, ends = _laid(*self._tokens(tokens.dictionary), tokens.indices.to_numpy())
        return ids, np.append(0, ends)[np.searchsorted(begin, edges[1:])]

    def _tokens(self, tokens: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different tokens of the splitter, in a row, and their ends; new ones are remembered."""
        found = pc.index_in(tokens, value_set=self.known)
        new = tokens.filter(found.is_null())
        ids, ends = self._merged(new)
        codes = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        codes[codes < 0] = len(self.known) + np.arange(len(new))
        ends = np.concatenate([self.ends, len(self.ids) + ends])
        ids = np.concatenate([self.ids, ids])
        out = _laid(ids, ends, codes)
        if len(ends) <= self.most:
            self.known, self.ids, self.ends = pa.concat_arrays([self.known, new]), ids, ends
        else:  # of these tokens only
            n = min(len(tokens), self.most)
            self.known, self.ends = pa.concat_arrays([tokens[:n]]), out[1][:n].copy()
            self.ids = out[0][: self.ends[-1] if n else 0].copy()
        return out

    def _merged(self, tokens: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the tokens by the merges alone, in a row, and their ends."""
        raw, edges = _bytes(pc.binary_join_element_wise("", tokens, "\0"))
        spelt, ids = _BYTE_CHARS[raw], array("I")
        step = 1 if self.nul is None else _MERGED
        ends = []
        for at in range(0, len(tokens), step):
            part = spelt[edges[at] + (self.nul is None) : edges[min(at + step, len(tokens))]]
            ids.extend([t.id for t in self.merge(part.tobytes().decode("utf-32-le"))])
            ends.append(len(ids))
        ids = np.frombuffer(ids, np.uintc)
        if self.nul is None:
            return ids.astype(self.kind), np.array(ends, np.int64)
        parts = ids == self.nul
        begin = np.flatnonzero(parts) - np.arange(len(tokens))
        ids = ids[~parts].astype(self.kind)
        return ids, np.append(begin[1:], len(ids)) if len(tokens) else begin


def id_type(vocabulary: int, end_id: int) -> str:
    """Type code of the ids in the files."""
    return "H" if max(vocabulary - 1, end_id) < 1 << 16 else "I"


def _store(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def _keyed(key: Column, copy: Column) -> list[Column]:
    text = F.coalesce(key.cast("string"), F.lit("\0null"))
    copy = copy.cast("long")
    return [F.xxhash64(text, copy).alias("h1"), F.xxhash64(copy, text, F.lit("b")).alias("h2")]


class TokenFiles:
    """A written folder: ``write`` makes it, ``lookup`` and ``read`` use it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """key, copy, shard, offset, n of the keys that the index holds.

        ``keys`` has columns key and, unless copy 0 is meant, copy. Equal keys
        are looked up once.
        """
        index = self.table("index")
        buckets = index.agg(F.first("buckets")).first()[0] or 1
        copy = F.col("copy") if "copy" in keys.columns else F.lit(0)
        keys = keys.select("key", copy.cast("long").alias("copy")).distinct()
        keys = keys.select("key", "copy", *_keyed(F.col("key"), F.col("copy")))
        keys = keys.withColumn("bucket", F.pmod("h1", F.lit(buckets)))
        kind = keys.schema["key"].dataType
        out = StructType([StructField("key", kind), *(StructField(c, LongType()) for c in ("copy", "shard", "offset", "n"))])

        def find(asked, bucket):
            import pandas as pd

            if not len(bucket) or not len(asked):
                return pd.DataFrame({f.name: pd.Series(dtype="object") for f in out})
            b = bucket.iloc[0]
            h1, h2 = asked["h1"].to_numpy().view(np.uint64), asked["h2"].to_numpy().view(np.uint64)
            slot = slots(h1, h2, np.frombuffer(b["moves"], np.int32), int(b["n"]), int(b["seed"]))
            found = np.frombuffer(b["prints"], np.uint64)[slot] == fingerprint(h1, h2)
            hit, slot = asked[found], slot[found]
            values = {c: np.frombuffer(b[c], np.int64)[slot] for c in ("shard", "offset", "length")}
            return pd.DataFrame(
                {
                    "key": hit["key"].to_numpy(),
                    "copy": hit["copy"].to_numpy(),
                    "shard": values["shard"],
                    "offset": values["offset"],
                    "n": values["length"],
                }
            )

        return keys.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(find, out)

    def read(self, located: DataFrame) -> DataFrame:
        """key, copy, start, n and ids of rows that ``lookup`` gave.

        ``start``: ids of all documents before; ``ids``: little-endian unsigned
        32-bit integers. A task opens each shard once and reads ahead in it.
        """
        shards = self.table("shards").select(F.col("shard").alias("s"), "file", "first", "kind")
        rows = located.join(shards, F.col("shard") == F.col("s"))
        rows = rows.select("key", "copy", "file", "offset", "n", (F.col("first") + F.col("offset")).alias("start"), "kind")
        rows = rows.repartition("file").sortWithinPartitions("file", "offset")
        path = self.path

        def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, folder = _store(path)
            opened, handle = None, None
            for batch in batches:
                x = batch.to_pydict()
                at = 0
                while at < batch.num_rows:
                    ids, held, begin = [], 0, at
                    while at < batch.num_rows and held < _HELD:
                        if x["file"][at] != opened:
                            if handle:
                                handle.close()
                            opened = x["file"][at]
                            handle = fs.open_input_file(f"{folder}/ids/{opened}")
                        kind = np.dtype("<u2" if x["kind"][at] == "H" else "<u4")
                        raw = handle.read_at(x["n"][at] * kind.itemsize, x["offset"][at] * kind.itemsize)
                        ids.append(np.frombuffer(raw, kind).astype("<u4").tobytes())
                        held += len(ids[-1])
                        at += 1
                    part = batch.slice(begin, at - begin)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in ("key", "copy", "start", "n")), pa.array(ids, pa.binary())],
                        ["key", "copy", "start", "n", "ids"],
                    )
            if handle:
                handle.close()

        kind = located.schema["key"].dataType
        out = StructType([StructField("key", kind), *(StructField(c, LongType()) for c in ("copy", "start", "n"))])
        return rows.mapInArrow(fetch, out.add("ids", "binary"))

    def read_all(self) -> DataFrame:
        """``read`` of every document, found by its key through the index."""
        return self.read(self.lookup(self.table("keys").select("key", "copy")))


def write(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    shard_bytes: int = SHARD_BYTES,
    bucket: int = BUCKET,
    known: int = KNOWN,
    keep: bool = True,
) -> TokenFiles:
    """Encodes every whole text and writes the folder ``path`` (which must be new).

    ``tokenizer_file`` is a path that all executors can open; ``known`` bounds what
    an encoder remembers of it; ``keep``: whether Python workers keep their encoder
    from task to task (quicker), or let it go (where they run other stages too).
    """
    spark = docs.sparkSession
    body = F.col(text).cast("string")
    size = docs.agg(F.sum(F.octet_length(body)).alias("bytes"), F.count("*").alias("rows")).first()
    parts = max(1, math.ceil((size.bytes or 0) / shard_bytes), math.ceil(size.rows / 2_000_000))
    rows = docs.select(F.col(key).alias("key"), body.alias("text"), F.xxhash64(body).alias("h"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    # by text and row as well, so that one key with very many rows is split
    order = [F.col("key").asc_nulls_first(), F.col("h").asc(), F.col("row").asc()]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("key", "text")
    schema = StructType([StructField("key", rows.schema["key"].dataType), StructField("file", rows.schema["text"].dataType)])
    for c in ("copy", "shard", "row", "offset", "n"):
        schema = schema.add(c, "long")
    fields = [f.name for f in schema]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_file, end_id, known)
        shard, name = TaskContext.get().partitionId(), None
        offset = row = copy = 0
        last: object = encoder  # equal to no key
        for batch in batches:
            if name is None:
                name = f"shard-{shard:06d}-{uuid.uuid4().hex}.bin"
                fs, folder = _store(path)
                fs.create_dir(f"{folder}/ids", recursive=True)
                out = fs.open_output_stream(f"{folder}/ids/{name}")
            keys, n, copies = batch.column(0).to_pylist(), [np.empty(0, np.int64)], []
            for part in runs(batch.column(1)):
                ids, of_each = encoder.encode_array(part)
                out.write(ids)
                n.append(of_each)
            for k in keys:
                copy = copy + 1 if k == last else 0
                copies.append(copy)
                last = k
            n = np.concatenate(n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([name] * len(n), pa.string()),
                    pa.array(copies, pa.int64()),
                    pa.array([shard] * len(n), pa.int64()),
                    pa.array(np.arange(row, row + len(n))),
                    pa.array(offset + np.cumsum(n) - n),
                    pa.array(n),
                ],
                fields,
            )
            row += len(n)
            offset += int(n.sum())
        if name is not None:
            out.close()
        if not keep:
            _ENCODERS.clear()
            del encoder, last
            release()

    rows.mapInArrow(encode, schema).write.parquet(f"{path}/written")
    files = TokenFiles(spark, path)
    _write_shards(files, tokenizer_file, end_id)
    written, shards = files.table("written"), files.table("shards")
    goes_on = F.col("key").eqNullSafe(F.col("first_key"))
    base = shards.select(F.col("shard").alias("s"), "first_key", "copies_before")
    keys = written.join(base, F.col("shard") == F.col("s")).select(
        "key", (F.col("copy") + F.when(goes_on, F.col("copies_before")).otherwise(0)).alias("copy"), "shard", "offset", "n"
    )
    keys.write.parquet(f"{path}/keys")
    _write_index(files, max(1, math.ceil(size.rows / bucket)))
    return files


def _write_shards(files: TokenFiles, tokenizer_file: str, end_id: int) -> None:
    """A row for each shard, with prefix sums over the shards."""
    per = files.table("written").groupBy("shard", "file")
    per = per.agg(
        F.sum("n").alias("n"),
        F.min_by(F.struct("key"), "row")["key"].alias("first_key"),
        F.max_by(F.struct("key", "copy"), "row").alias("last"),
    )
    order = W.orderBy("shard")
    tail = F.sum(F.col("last.copy") + 1).over(W.partitionBy("last.key").orderBy("shard"))
    before, tail_before = F.lag("last.key").over(order), F.lag("tail").over(order)
    goes_on = (F.col("shard") > F.min("shard").over(W.partitionBy())) & F.col("first_key").eqNullSafe(before)
    encoder = _encoder(tokenizer_file, end_id)
    per.withColumn("tail", tail).select(
        "shard",
        "file",
        "n",
        F.coalesce(F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"),
        "first_key",
        F.when(goes_on, tail_before).otherwise(F.lit(0)).alias("copies_before"),
        F.lit(encoder.kind).alias("kind"),
    ).write.parquet(f"{files.path}/shards")


def _write_index(files: TokenFiles, buckets: int) -> None:
    keys = files.table("keys").select(*_keyed(F.col("key"), F.col("copy")), "shard", "offset", "n")

    def build(rows):
        import pandas as pd

        h1, h2 = rows["h1"].to_numpy().view(np.uint64), rows["h2"].to_numpy().view(np.uint64)
        moves, seed = perfect_hash(h1, h2)
        slot = slots(h1, h2, moves, len(rows), seed)
        at = np.empty(len(rows), np.int64)
        at[slot] = np.arange(len(rows))
        values = {c: rows[c].to_numpy(np.int64)[at].tobytes() for c in ("shard", "offset", "n")}
        return pd.DataFrame(
            {
                "bucket": [rows["bucket"].iloc[0]],
                "buckets": [buckets],
                "n": [len(rows)],
                "seed": [seed],
                "moves": [moves.tobytes()],
                "prints": [fingerprint(h1, h2)[at].tobytes()],
                "shard": [values["shard"]],
                "offset": [values["offset"]],
                "length": [values["n"]],
            }
        )

    bucketed = keys.withColumn("bucket", F.pmod("h1", F.lit(buckets)))
    schema = "bucket long, buckets long, n long, seed long, moves binary, prints binary, shard binary, offset binary, length binary"
    bucketed.groupBy("bucket").applyInPandas(build, schema).write.parquet(f"{files.path}/index")


def fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return mix64(h1 * _GOLDEN + h2)


def slots(h1: np.ndarray, h2: np.ndarray, moves: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Slot of each key: below zero, a move is the slot of a group of one."""
    move = moves[(_group_hash(h1, seed) % np.uint64(len(moves))).astype(np.int64)].astype(np.int64)
    return np.where(move < 0, -move - 1, _place(h2, np.maximum(move, 0), n))


def _group_hash(h1: np.ndarray, seed: int) -> np.ndarray:
    return mix64(h1 ^ (np.uint64(seed) * _GOLDEN))


def _place(h2: np.ndarray, move: np.ndarray, n: int) -> np.ndarray:
    return (mix64(h2 ^ (move.astype(np.uint64) * _GOLDEN)) % np.uint64(n)).astype(np.int64)


def perfect_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, int]:
    """A move for each group so that ``slots`` is a bijection to 0 ... n - 1."""
    n = len(h1)
    groups = max(1, n // 2)
    for seed in range(1, 1000):
        group = (_group_hash(h1, seed) % np.uint64(groups)).astype(np.int64)
        moves, free, fits = np.zeros(groups, np.int32), np.ones(n, bool), True
        by = np.argsort(group, kind="stable")
        own = np.split(by, np.flatnonzero(np.diff(group[by])) + 1)
        own.sort(key=len, reverse=True)
        many = [g for g in own if len(g) > 1]
        for g in many:
            fits = _settle(g, group, h2, moves, free, n)
            if not fits:
                break
        if not fits:
            continue
        left = np.flatnonzero(free)
        for g, slot in zip(own[len(many) :], left, strict=True):
            moves[group[g[0]]] = -slot - 1
        return moves, seed
    raise ValueError("no perfect hash found: two keys have the same 128-bit hash")


def _settle(g: np.ndarray, group: np.ndarray, h2: np.ndarray, moves: np.ndarray, free: np.ndarray, n: int) -> bool:
    for start in range(0, 1 << 16, 256):
        move = np.arange(start, start + 256)
        at = _place(h2[g][:, None], move[None, :], n)
        good = free[at].all(axis=0)
        if len(g) > 1:
            ordered = np.sort(at, axis=0)
            good &= (ordered[1:] != ordered[:-1]).all(axis=0)
        hit = np.flatnonzero(good)
        if len(hit):
            moves[group[g[0]]] = move[hit[0]]
            free[at[:, hit[0]]] = False
            return True
    return False


def _encoder(file: str, end_id: int, known: int = KNOWN) -> Encoder:
    """One encoder for each Python worker, so that it remembers between tasks."""
    if (file, end_id) not in _ENCODERS:
        _ENCODERS[file, end_id] = Encoder(file, end_id)
    encoder = _ENCODERS[file, end_id]
    encoder.most = known
    return encoder


_ENCODERS: dict[tuple[str, int], Encoder] = {}
