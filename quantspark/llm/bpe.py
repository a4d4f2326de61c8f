"""Byte-level BPE encoding and decoding against a file of ranked byte pieces.

1. Texts are cut by the tokenizer's pattern (``regexp_extract_all``), once.
2. Within each task, documents are gathered into blocks; a block holds its
   distinct words once and each document as positions in them. Blocks are staged;
   no document is shuffled.
3. Each distinct word, as an array of bytes, is folded with higher-order
   functions: the adjacent pair of lowest rank is merged until no pair has a
   rank. The rank map is a literal: an array of small maps, reached by a
   checksum of the piece, so that a look-up doesn't scan 50,000 entries.
4. Documents are put together from their words' ids; decoding joins the binary
   pieces of the ids.

Words that stand in many blocks are folded once for all of them: at most
``cache_words``, of ``CACHE_BYTES`` bytes or fewer, are kept in a table that all
tasks read. This saves work and changes no result.

Bytes are written as the code points 0 to 255 while they are folded, so that
pieces are strings. In words of more than ``LONG`` parts all places of the
lowest pair are merged at once (two code points above 255 mark a part's ends);
every pair with the new piece has a higher rank, so the result is the same.
Words are first cut at places that no piece of the vocabulary can reach over, as
no merge can cross them; the distinct parts are what is folded.

Defined cases: a null or empty text has no tokens and decodes to nothing; ids
may be null or repeated; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantspark.llm.common import open_fs, read, scoped, shared_path, stage

VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK_WORDS = 1 << 20
CACHE_WORDS, CACHE_BYTES = 3 << 18, 64
BUCKETS = 1 << 14
LONG = 48
PROBED = 1 << 12  # code points at a time
OPEN, CLOSE = "Ā", "ā"
# The literal would be printed in full with every plan that the driver keeps.
SHORT_PLANS = {"maxPlanStringLength": "20000"}
# Unicode White_Space: what \s means in the tokenizer's pattern.
SPACES = r"\t-\r\x20\x85\xA0  -     　"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _ranges(points: np.ndarray) -> str:
    """Code points as the inside of a Java character class."""
    if not len(points):
        return ""
    cut = np.flatnonzero(np.diff(points) > 1)
    first, last = points[np.r_[0, cut + 1]], points[np.r_[cut, len(points) - 1]]
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in zip(first, last))


def _matched(probe, at: int) -> list[int]:
    """Of ``PROBED`` code points from ``at`` on, those that the probe's pattern matches."""
    text = "".join(chr(i) for i in range(at, at + PROBED) if not 0xD800 <= i < 0xE000)
    return list(map(ord, bytes(probe.encode_ordinary(text)).decode()))


@lru_cache(maxsize=1)
def _newer(spark: SparkSession) -> dict[str, str]:
    """Code points that the tokenizer's library counts as \\p{L} or \\p{N} and
    this Java, of an older Unicode, doesn't."""
    import tiktoken
    bytes_only = {bytes([i]): i for i in range(256)}
    # rows, not a literal of all code points: the driver would keep it, printed, with the plan
    points = spark.range(0x110000).filter((F.col("id") < 0xD800) | (F.col("id") >= 0xE000))
    points = points.withColumn("x", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32"))
    out = {}
    for kind in ("L", "N"):
        probe = tiktoken.Encoding(f"probe-{kind}", pat_str=rf"\p{{{kind}}}", mergeable_ranks=bytes_only, special_tokens={})
        theirs = [i for at in range(0, 0x110000, PROBED) for i in _matched(probe, at)]
        known = points.filter(F.col("x").rlike(rf"\p{{{kind}}}")).select("id").toArrow().column("id").to_numpy()
        out[kind] = _ranges(np.setdiff1d(np.array(theirs, np.int64), known))
    return out


def pattern(more_letters: str = "", more_numbers: str = "") -> str:
    """The tokenizer's pattern for Java, with its white space spelled out."""
    import public_tokenizers
    p = public_tokenizers.PATTERN
    p = p.replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACES}\p{{L}}\p{{N}}{more_letters}{more_numbers}]").replace(r"(?!\S)", f"(?![^{SPACES}])")
    p = p.replace(r"\s", f"[{SPACES}]")
    return p.replace(r" ?\p{L}+", rf" ?[\p{{L}}{more_letters}]+").replace(r" ?\p{N}+", rf" ?[\p{{N}}{more_numbers}]+")


def _matches(spark: SparkSession) -> Column:
    """Matches of the pattern; its longer form only for texts with a code point
    from the first one on that Java lacks."""
    newer, text = _newer(spark), F.coalesce("text", F.lit(""))
    plain = F.regexp_extract_all(text, F.lit(pattern()), F.lit(0))
    if not newer["L"] + newer["N"]:
        return plain
    least = min(int(x, 16) for x in re.findall(r"x\{([0-9A-F]+)\}", newer["L"] + newer["N"]))
    full = F.regexp_extract_all(text, F.lit(pattern(newer["L"], newer["N"])), F.lit(0))
    return F.when(text.rlike(rf"[\x{{{least:X}}}-\x{{10FFFF}}]"), full).otherwise(plain)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _bytes_as_text(word: Column) -> Column:
    return F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")


def _bucket(piece: Column) -> Column:
    return (F.crc32(piece.cast("binary")) % BUCKETS).cast("int")


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """A constant array of ``BUCKETS`` small maps, piece -> rank."""
    buckets: list[dict] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        text = piece.decode("latin-1")
        buckets[zlib.crc32(text.encode()) % BUCKETS][text] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def _rank_of(literal: Column, piece: Column) -> Column:
    return F.get(literal, _bucket(piece))[piece]


def _let(value: Column, body) -> Column:
    """``body`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def encode_words(words: Column, literal: Column) -> Column:
    """array<string> of byte-words -> array<array<int>> of ids."""
    # transform and filter by position here: slice() and concat() of arrays cost several times as much
    def ranks_of(table, parts):
        # pair i is parts i and i + 1; the last, with nothing after it, has no rank
        return F.transform(parts, lambda x, i: _rank_of(table, F.concat(x, F.get(parts, i + 1))))

    def state_of(parts, ranks):
        return _let(ranks, lambda r: F.struct(parts.alias("parts"), r.alias("ranks"), F.array_min(r).alias("least")))

    def merge_one(table, parts, ranks, at):
        """The pair at ``at`` (from 1) as one part; only its neighbours' ranks change."""
        def with_piece(piece):
            left = _rank_of(table, F.concat(F.get(parts, at - 2), piece))
            right = _rank_of(table, F.concat(piece, F.get(parts, at + 1)))
            new_parts = F.transform(parts, lambda x, i: F.when(i == at - 1, piece).otherwise(x))
            new_ranks = F.transform(ranks, lambda x, i: F.when(i == at - 2, left).when(i == at, right).otherwise(x))
            return state_of(F.filter(new_parts, lambda x, i: i != at), F.filter(new_ranks, lambda x, i: i != at - 1))

        return _let(F.concat(F.get(parts, at - 1), F.get(parts, at)), with_piece)

    def merge_all(table, parts, at):
        """Every non-overlapping place of the pair at ``at``, from the left, in
        a few passes over a long word."""
        a, b = F.get(parts, at - 1), F.get(parts, at)
        marked = F.concat(F.lit(OPEN), F.array_join(parts, CLOSE + OPEN), F.lit(CLOSE))
        done = F.replace(marked, F.concat(F.lit(OPEN), a, F.lit(CLOSE + OPEN), b, F.lit(CLOSE)),
                         F.concat(F.lit(OPEN), a, b, F.lit(CLOSE)))
        merged = F.split(F.rtrim(F.replace(done, F.lit(OPEN), F.lit("")), F.lit(CLOSE)), CLOSE)
        return _let(merged, lambda m: state_of(m, ranks_of(table, m)))

    def encode(table, word):
        def step(state, _):
            parts, ranks = state["parts"], state["ranks"]

            def merge(at):
                return F.when(F.size(parts) <= LONG, merge_one(table, parts, ranks, at)).otherwise(merge_all(table, parts, at))

            # after the last merge a step costs nothing
            return F.when(state["least"].isNull(), state).otherwise(_let(F.array_position(ranks, state["least"]).cast("int"), merge))

        def ids(state):
            return F.transform(state["parts"], lambda x: _rank_of(table, x))

        def folded(chars):
            start = state_of(chars, ranks_of(table, chars))
            most = F.greatest(F.size(chars) - 1, F.lit(1))
            # a long word's steps, each of which copies its state, go in runs that are left out after the last merge
            run = F.sequence(F.lit(1), F.ceil(F.sqrt(most)).cast("int"))
            in_runs = F.aggregate(run, start, lambda state, _: F.aggregate(
                F.when(state["least"].isNull(), F.array().cast("array<int>")).otherwise(run), state, step), ids)
            return F.when(most < LONG, F.aggregate(F.sequence(F.lit(1), most), start, step, ids)).otherwise(in_runs)

        return _let(_rank_of(table, word), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(_let(F.split(word, ""), folded)))

    return _let(literal, lambda table: F.transform(words, lambda word: encode(table, word)))


class Cutter:
    """Cuts words where no merge can cross: at a place that no piece of the
    vocabulary, matched at any place of the word, reaches over. Pieces are found
    by a 64-bit hash, first in a bit table, then among those of their length."""

    BASE, BITS = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - 23)

    def __init__(self, ranks: dict[bytes, int]):
        self.longest = max(map(len, ranks))
        self.table = np.zeros(1 << 23, bool)
        self.hashes: dict[int, np.ndarray] = {}
        by_size: dict[int, list[bytes]] = {}
        for piece in ranks:
            if len(piece) > 1:
                by_size.setdefault(len(piece), []).append(piece)
        for size, pieces in by_size.items():
            b = np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, size)
            h = np.zeros(len(b), np.uint64)
            for i in range(size):
                h = h * self.BASE + b[:, i] + np.uint64(1)
            self.table[self._slot(h)] = True
            self.hashes[size] = np.sort(h)

    def _slot(self, h):
        return ((h ^ (h >> np.uint64(29))) * self.BASE) >> self.BITS

    def _crossed(self, b: np.ndarray) -> np.ndarray:
        """Of words as rows of ``size`` bytes: whether a piece reaches over the place before byte 1, 2, .."""
        n, size = b.shape
        h, delta = b.astype(np.uint64) + np.uint64(1), np.zeros((n, size + 1), np.int32)
        for more in range(1, min(size, self.longest)):
            h = h[:, :-1] * self.BASE + b[:, more:] + np.uint64(1)
            own = self.hashes.get(more + 1)
            if own is None:
                continue
            hit = self.table[self._slot(h)]
            at = np.nonzero(hit)
            found = h[at]
            hit[at] = own[np.minimum(np.searchsorted(own, found), len(own) - 1)] == found
            delta[:, 1:size - more + 1] += hit
            delta[:, more + 1:] -= hit
        return np.cumsum(delta, axis=1)[:, 1:size] > 0

    def cut(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """All words' parts in order, and the number of parts of each word."""
        sizes = np.array([len(w) for w in words], np.int64)
        counts = np.ones(len(words), np.int64)
        cuts: list[list[int]] = [[]] * len(words)
        for size in np.unique(sizes[sizes > 1]):
            rows = np.flatnonzero(sizes == size)
            b = np.frombuffer(b"".join([words[r] for r in rows]), np.uint8).reshape(-1, int(size))
            free = ~self._crossed(b)
            for r in np.flatnonzero(free.any(axis=1)):
                cuts[rows[r]] = (np.flatnonzero(free[r]) + 1).tolist()
                counts[rows[r]] += len(cuts[rows[r]])
        parts = []
        for word, at in zip(words, cuts):
            edges = [0, *at, len(word)]
            parts.extend([word[i:j] for i, j in zip(edges[:-1], edges[1:])])
        return parts, counts


def _ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def _take(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenation of values[start:start + size]."""
    begin, ends = _ragged(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - begin, sizes) + np.arange(total)]


class WordCache:
    """Frequent words and their ids, kept as a table in the shared folder, of
    which each Python worker reads once what it needs."""

    loaded: dict[tuple[str, str], object] = {}

    @staticmethod
    def build(blocks: DataFrame, literal: Column, cache_words: int) -> str:
        """Folder of the cache's table."""
        words = (blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
                 .filter((F.col("n") > 1) & (F.octet_length("word") <= CACHE_BYTES)))
        # at most a few hundred classes of counts; the most frequent ones that fit are taken whole
        words = stage(words.select("word", F.floor(F.log2("n") * 8).cast("int").alias("class")), "words")
        room, least = cache_words, None
        for row in words.groupBy("class").count().orderBy(F.desc("class")).collect():
            room -= row["count"]
            if room < 0:
                break
            least = row["class"]
        top = words.filter(F.lit(False) if least is None else F.col("class") >= least)
        groups = top.groupBy(F.pmod(F.xxhash64("word"), F.lit(1024)).alias("g")).agg(F.collect_list("word").alias("words"))
        groups = stage(groups.withColumn("w", F.transform("words", _bytes_as_text)), "word-groups")
        folder = shared_path(blocks.sparkSession, "word-cache")
        # the literal stands in plans without shuffles only, which aren't planned again as they run
        with scoped(blocks.sparkSession, **SHORT_PLANS):
            _encoded(groups, literal).select("words", "ids").write.parquet(folder)
        return folder

    @classmethod
    def _columns(cls, folder: str, name: str) -> list[pa.Array]:
        import pyarrow.parquet as pq
        from pyarrow import fs
        files, root = open_fs(folder)
        names = sorted(f.path for f in files.get_file_info(fs.FileSelector(root)) if f.base_name.endswith(".parquet"))
        return [c.flatten() for n in names for c in pq.read_table(n, columns=[name], filesystem=files).column(name).chunks]

    @classmethod
    def _once(cls, folder: str, name: str, make):
        if (folder, name) not in cls.loaded:
            for key in [k for k in cls.loaded if k[0] != folder]:  # one cache at a time
                del cls.loaded[key]
            cls.loaded[folder, name] = make(cls._columns(folder, name))
            pa.default_memory_pool().release_unused()
        return cls.loaded[folder, name]

    @classmethod
    def words(cls, folder: str) -> pa.Array:
        return cls._once(folder, "words", lambda chunks: pa.concat_arrays(chunks or [pa.array([], pa.string())]))

    @classmethod
    def ids(cls, folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, sizes, ids) in the order of ``words``."""
        def flat(chunks):
            none = np.zeros(0, np.int32)
            sizes = np.concatenate([none, *(pc.list_value_length(c).to_numpy(zero_copy_only=False).astype(np.int32) for c in chunks)]).astype(np.int64)
            return _ragged(sizes)[0], sizes, np.concatenate([none, *(c.flatten().to_numpy(zero_copy_only=False).astype(np.int32) for c in chunks)])

        return cls._once(folder, "ids", flat)


def _encoded(blocks: DataFrame, literal: Column) -> DataFrame:
    """With the ids of the words ``w``, which are text of bytes."""
    return blocks.withColumn("ids", encode_words(F.col("w"), literal))


def _blocks(docs: DataFrame) -> DataFrame:
    """One row per block: the documents' ids and word counts, each word as an index
    into the block's distinct words, and those words."""
    schema = T.StructType([
        T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)), T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("codes", T.BinaryType()), T.StructField("words", T.ArrayType(T.StringType()))])

    def run(batches):
        for batch in batches:
            lists, ids = batch.column(1), batch.column(0)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            begin, ends = _ragged(sizes)
            i = 0
            while i < len(sizes):
                j = max(i + 1, int(np.searchsorted(ends, begin[i] + BLOCK_WORDS, "right")))
                coded = pc.dictionary_encode(lists.slice(i, j - i).flatten())
                # frequent words first: the codes then compress well
                codes = coded.indices.to_numpy(zero_copy_only=False)
                order = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
                place = np.empty(len(order), np.int32)
                place[order] = np.arange(len(order), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids.slice(i, j - i).to_pylist()], pa.list_(ids.type)),
                    pa.array([sizes[i:j].astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([pa.compress(place[codes].tobytes(), codec="zstd", asbytes=True)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), coded.dictionary.take(pa.array(order)))], names=schema.names)
                i = j
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", _matches(docs.sparkSession).alias("m")).mapInArrow(run, schema)


def _own_words(blocks: DataFrame, cache: str, cutter: Cutter) -> DataFrame:
    """The blocks with, for each of their words, an index into the cache, or -1 - an
    index into their own words; the number of parts of each own word, each part's
    index, and the distinct parts ``w`` as text of bytes."""
    shared = blocks.sparkSession.sparkContext.broadcast(cutter)  # of a fixed size
    schema = T.StructType([*blocks.schema.fields[:3], T.StructField("places", T.BinaryType()), T.StructField("counts", T.BinaryType()),
                           T.StructField("parts", T.BinaryType()), T.StructField("w", T.ArrayType(T.StringType()))])

    def run(batches):
        known, cutter = WordCache.words(cache), shared.value
        for batch in batches:
            # one look-up for all blocks of the batch
            found = pc.fill_null(pc.index_in(batch.column(3).flatten(), value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int32)
            ends = np.cumsum(pc.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False))
            for r, end in enumerate(ends.tolist()):
                words = batch.column(3).slice(r, 1).flatten()
                place = found[end - len(words):end].copy()
                own = np.flatnonzero(place < 0)
                place[own] = -1 - np.arange(len(own), dtype=np.int32)
                parts, counts = cutter.cut([w.encode() for w in words.take(pa.array(own)).to_pylist()])
                distinct = pc.dictionary_encode(pa.array(parts, pa.binary()))
                yield pa.RecordBatch.from_arrays([
                    *(c.slice(r, 1) for c in batch.columns[:3]), pa.array([place.tobytes()], pa.binary()), pa.array([counts.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([distinct.indices.to_numpy(zero_copy_only=False).astype(np.int32).tobytes()], pa.binary()),
                    pa.array([[p.decode("latin-1") for p in distinct.dictionary.to_pylist()]], pa.list_(pa.string()))], names=schema.names)
            pa.default_memory_pool().release_unused()

    return blocks.mapInArrow(run, schema)


def _assemble(blocks: DataFrame, cache: str, finish, schema: T.StructType) -> DataFrame:
    """``finish(doc_ids, offsets, ids)`` makes a record batch of documents whose
    ids are ids[offsets[i]:offsets[i + 1]]."""
    def run(batches):
        starts, sizes, ids = WordCache.ids(cache)
        for batch in batches:
            for b in range(batch.num_rows):
                words = batch.column(1).slice(b, 1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                raw = pa.decompress(batch.column(2)[b].as_py(), int(words.sum()) * 4, codec="zstd", asbytes=True)
                codes, places, counts, parts = (np.frombuffer(x, np.int32) for x in (raw, *(batch.column(c)[b].as_py() for c in (3, 4, 5))))
                own = batch.column(6).slice(b, 1).flatten()
                part_sizes = pc.list_value_length(own).to_numpy(zero_copy_only=False).astype(np.int64)
                mine = part_sizes[parts]
                own_sizes = np.add.reduceat(mine, _ragged(counts.astype(np.int64))[0]) if len(counts) else counts
                own_ids = _take(own.flatten().to_numpy(zero_copy_only=False).astype(np.int32), _ragged(part_sizes)[0][parts], mine)
                # own words after the cached ones
                all_ids = np.concatenate([ids, own_ids])
                all_sizes = np.concatenate([sizes, own_sizes]).astype(np.int64)
                all_starts = np.concatenate([starts, len(ids) + _ragged(own_sizes)[0]])
                at = np.where(places >= 0, places, len(sizes) - 1 - places)[codes]
                doc_ids = batch.column(0).slice(b, 1).flatten()
                begin, ends = _ragged(words)
                i = 0
                while i < len(words):  # a bounded number of words at a time
                    j = max(i + 1, int(np.searchsorted(ends, begin[i] + (1 << 18), "right")))
                    mine = at[begin[i]:ends[j - 1]]
                    lengths = all_sizes[mine]
                    flat = _take(all_ids, all_starts[mine], lengths)
                    total = np.concatenate([[0], np.cumsum(lengths)])
                    yield finish(doc_ids.slice(i, j - i), total[np.concatenate([begin[i:j] - begin[i], [ends[j - 1] - begin[i]]])], flat)
                    i = j

    return blocks.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str | None = None, finish=None, schema: T.StructType | None = None,
           cache_words: int = CACHE_WORDS) -> DataFrame:
    """(doc_id, ids: array<int>), or what ``finish`` makes of them."""
    docs = docs.select("doc_id", "text")
    ranks = load_ranks(path or vocabulary_path())
    literal = rank_literal(ranks)
    if finish is None:
        schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

        def finish(doc_ids, offsets, ids):
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            return pa.RecordBatch.from_arrays([doc_ids, lists], names=["doc_id", "ids"])

    # small Arrow batches, as a task holds several at a time; plans with the literal are kept by the driver, so they run here
    with scoped(docs.sparkSession, execution__arrow__maxRecordsPerBatch="1500", execution__arrow__maxBytesPerBatch="8m", **SHORT_PLANS):
        blocks = stage(_blocks(docs), "blocks")
        cache = WordCache.build(blocks, literal, cache_words)
        return stage(_assemble(_encoded(_own_words(blocks, cache, Cutter(ranks)), literal).drop("w"), cache, finish, schema), "encoded")


def pieces_by_id(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        out[i] = piece
    return out


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) -> (doc_id, data: binary)."""
    pieces = pieces_by_id(load_ranks(path or vocabulary_path()))
    schema = T.StructType([encoded.schema["doc_id"], T.StructField("data", T.BinaryType())])

    def run(batches):
        for batch in batches:
            data = [b"".join(map(pieces.__getitem__, ids or ())) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def digests(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ids and the bytes decoded
    from them are hashed in the task that has them."""
    pieces = pieces_by_id(load_ranks(path or vocabulary_path()))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def finish(doc_ids, offsets, ids):
        names = list(map(str, range(len(pieces))))
        shown, back = [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            mine = ids[a:b].tolist()
            shown.append(hashlib.sha256(" ".join(map(names.__getitem__, mine)).encode()).hexdigest())
            back.append(hashlib.sha256(b"".join(map(pieces.__getitem__, mine))).hexdigest())
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(np.diff(offsets)), pa.array(shown), pa.array(back)], names=schema.names)

    return encode(docs, path, finish, schema, **options)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))
