"""Encoding a whole corpus by a public byte-level BPE, each distinct word once.

Plan: texts are cut into pre-tokens once, and the cut texts written out.  The
distinct pre-tokens of the corpus are counted with map-side combine and encoded
once each.  Words that make up a large share of all occurrences (a bounded
number of them, by arithmetic) are looked up where the text lies, in whole
Arrow columns; in their place come ids, in the place of all others holes.  The
others are exploded with their positions, shuffled on the word, joined with
their ids and put into the holes, so no task gets all occurrences of a common
word, and a text of common words is never shuffled.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ..sources.tables import materialise

#: Where the vocabulary files lie; every function takes another place.
TOKENIZER_DIR = "/opt/tokenizers"

# Fixed value: the published pre-tokenisation pattern of the byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Same pattern for the JVM: white space by Unicode, as the tokenizer has it.
JVM_PATTERN = "(?U)" + PATTERN


@lru_cache(maxsize=4)
def _ranks(path: str) -> dict[bytes, int]:
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


@lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken

    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=_ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def _splitter(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).pre_tokenizer


def vocabulary_file(name: str = "byte_bpe_50k", root: str = TOKENIZER_DIR) -> str:
    return str(Path(root, f"{name}.tiktoken"))


def with_pieces(df: DataFrame, text: str, root: str = TOKENIZER_DIR) -> DataFrame:
    """``df`` and the array ``pieces`` of pre-tokens; concatenated they give the text again.

    Texts with characters the JVM's Unicode tables do not know yet are cut by the tokenizer's own
    splitter instead, so the cut never depends on the age of those tables.
    """
    ship(df.sparkSession)
    unknown = F.coalesce(F.col(text).rlike(r"\p{Cn}"), F.lit(False))
    jvm = df.withColumn("pieces", F.when(~unknown, F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(JVM_PATTERN), F.lit(0))))
    path = str(Path(root, "byte_bpe_50k.json"))

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        splitter = _splitter(path)
        return texts.map(lambda t: None if t is None else [t[a:b] for _, (a, b) in splitter.pre_tokenize_str(t)])

    # the UDF sees NULL for every text the JVM has cut
    return jvm.withColumn("pieces", F.coalesce("pieces", cut(F.when(unknown, F.col(text)))))


def encode_words(counts: DataFrame, name: str = "byte_bpe_50k", root: str = TOKENIZER_DIR) -> DataFrame:
    """``word, n, ids`` of distinct pre-tokens with their counts (a pre-token is never cut again)."""
    ship(counts.sparkSession)
    path = vocabulary_file(name, root)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoding(path)
        for b in batches:
            yield b.assign(ids=[enc._encode_single_piece(w) for w in b["word"]])

    return counts.select("word", "n").mapInPandas(run, "word string, n bigint, ids array<int>")


HOLE = -1


def _with_holes(cut: DataFrame, heavy: list[tuple[str, list[int]]]) -> DataFrame:
    """``cut`` with ``ids`` in place of ``pieces``: those of heavy words, holes for the others, which stand in ``rare``."""
    kept = [f for f in cut.schema.fields if f.name != "pieces"]
    words = [w for w, _ in heavy]
    ids = [i for _, i in heavy] + [[HOLE]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lists = pa.array(words, pa.string()), pa.array(ids, pa.list_(pa.int32()))
        lengths = np.array([len(i) for i in ids], dtype=np.int64)
        for b in batches:
            pieces = b.column(b.schema.get_field_index("pieces"))
            flat = pieces.flatten()
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(pieces).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))])
            at = pc.index_in(flat, value_set=known)
            missing = at.is_null().to_numpy(zero_copy_only=False)
            at = at.fill_null(len(words))
            total = np.concatenate([[0], np.cumsum(lengths[at.to_numpy(zero_copy_only=False)])])
            holes = np.concatenate([[0], np.cumsum(missing)])
            with_ids = pa.ListArray.from_arrays(pa.array(total[ends], pa.int32()), lists.take(at).flatten())
            rare = pa.ListArray.from_arrays(pa.array(holes[ends], pa.int32()), flat.filter(pa.array(missing)).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(f.name)) for f in kept), with_ids, rare], names=[*(f.name for f in kept), "ids", "rare"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "ids array<int>, rare array<string>"])
    return cut.mapInArrow(run, schema)


def _filled(ids: pd.Series, parts: pd.Series) -> pd.Series:
    out = []
    for row, put in zip(ids, parts, strict=True):
        row = np.asarray(row, dtype=np.int32)
        pieces = np.split(row, np.flatnonzero(row == HOLE))
        for k, part in enumerate(put, 1):
            pieces[k] = np.concatenate([np.asarray(part, dtype=np.int32), pieces[k][1:]])
        out.append(np.concatenate(pieces))
    return pd.Series(out, dtype=object)


def _looked_up(docs: DataFrame, text: str, name: str, root: str, heavy_share: float) -> tuple[DataFrame, DataFrame]:
    """Rows ``__row, __key, ids, rare`` with the heavy words looked up, and the table ``word, n, ids`` of all words."""
    rows = docs.select("__key", F.col(text).cast("string").alias("__t"))
    cut = materialise(with_pieces(rows, "__t", root).select(F.monotonically_increasing_id().alias("__row"), "__key", "pieces"), "pieces")
    counts = cut.select(F.explode("pieces").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # each distinct word is encoded once and kept in a table that outlives executors
    words = materialise(encode_words(counts, name, root), "words")
    total = words.agg(F.sum("n").alias("n")).first()["n"] or 0
    # at most 1 / heavy_share words are heavy
    heavy = [(r["word"], list(r["ids"])) for r in words.filter(F.col("n") >= F.lit(max(1.0, heavy_share * total))).collect()]
    return materialise(_with_holes(cut, heavy), "with-holes"), words


def encode_corpus(
    docs: DataFrame, key: str, text: str, *, name: str = "byte_bpe_50k", root: str = TOKENIZER_DIR, heavy_share: float = 0.001
) -> DataFrame:
    """``key, ids``: one row for each row of ``docs``; NULL and empty texts give the empty list.

    No special tokens: their strings in a text are ordinary text.  Keys may repeat and be NULL: every row
    is encoded for itself.  Very long texts are cut like others; what must fit in a task is one text's
    ids.  Other columns are ignored.
    """
    rows, words = _looked_up(docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")), "__text", name, root, heavy_share)
    whole = rows.filter(F.size("rare") == 0).select("__key", "ids")
    holed = rows.filter(F.size("rare") > 0)
    places = holed.select("__row", F.posexplode("rare").alias("pos", "word")).join(words.select("word", F.col("ids").alias("part")), "word")
    parts = places.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("pos", "part"))).alias("p")).select("__row", F.transform("p", lambda p: p["part"]).alias("parts"))
    filled = holed.select("__row", "__key", "ids").join(parts, "__row").select("__key", F.pandas_udf(_filled, "array<int>")("ids", "parts").alias("ids"))
    return whole.unionByName(filled).withColumnRenamed("__key", key)


def with_token_counts(
    docs: DataFrame, text: str, *, count: str = "n_tokens", name: str = "byte_bpe_50k", root: str = TOKENIZER_DIR, heavy_share: float = 0.001
) -> DataFrame:
    """The columns of ``docs`` but ``text``, and the number of tokens of each row's text; no list of ids is built."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("__key"), F.col(text).alias("__text"))
    rows, words = _looked_up(packed, "__text", name, root, heavy_share)
    own = F.size("ids") - F.size("rare")
    whole = rows.filter(F.size("rare") == 0).select("__key", F.size("ids").cast("bigint").alias("__n"))
    holed = rows.filter(F.size("rare") > 0)
    occurrences = holed.select("__row", F.explode("rare").alias("word")).groupBy("__row", "word").agg(F.count(F.lit(1)).alias("times"))
    sums = occurrences.join(words.select("word", F.size("ids").alias("long")), "word").groupBy("__row").agg(F.sum(F.col("times") * F.col("long")).alias("more"))
    filled = holed.select("__row", "__key", own.alias("own")).join(sums, "__row").select("__key", (F.col("own") + F.col("more")).cast("bigint").alias("__n"))
    return whole.unionByName(filled).select("__key.*", F.col("__n").alias(count))


def token_bytes(spark, name: str = "byte_bpe_50k", root: str = TOKENIZER_DIR) -> DataFrame:
    """``id, hex``: the bytes of each id; as many rows as the vocabulary has."""
    ranks = _ranks(vocabulary_file(name, root))
    return spark.createDataFrame(pd.DataFrame({"id": list(ranks.values()), "hex": [t.hex() for t in ranks]}), "id int, hex string")


def decode_corpus(encoded: DataFrame, key: str, ids: str = "ids", *, name: str = "byte_bpe_50k", root: str = TOKENIZER_DIR) -> DataFrame:
    """``key, text`` of encoded rows, by joining the token-byte table; the empty list gives ''.

    Keys must be distinct.  Ids outside the vocabulary give no bytes.
    """
    table = F.broadcast(token_bytes(encoded.sparkSession, name, root))  # bounded by the vocabulary
    flat = encoded.select(F.col(key).alias("k"), F.posexplode_outer(ids).alias("pos", "id")).join(table, "id", "left")
    joined = flat.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("hex", F.lit("")).alias("hex")))).alias("p"))
    return joined.select(F.col("k").alias(key), F.unhex(F.array_join(F.transform("p", lambda p: p["hex"]), "")).cast("string").alias("text"))
