"""Order-independent fingerprints of documents by a homomorphic multiset hash.

A text is a multiset of paragraphs (its lines). Every paragraph is hashed to a wide
vector and a text's fingerprint is the sum of its paragraphs' vectors, lane by lane,
modulo a power of two. So the order of paragraphs does not matter, and a paragraph is
inserted or deleted by adding or subtracting its vector, without the rest of the text.

A paragraph's vector has two parts:

* ``IDENTITY_LANES`` lanes of 32 bits hashed from the whole paragraph; they tell texts
  apart (equal texts have equal lanes, others with a chance of 2**-256);
* ``LIKENESS_LANES`` lanes of 32 bits: the paragraph's windows of ``WINDOW`` words add
  +1 or -1 to each lane, by a bit of the window's hash. Lanes of texts that share
  windows are correlated, and the cosine of two texts' lanes estimates that of their
  multisets of windows, with a standard error of about 1 / sqrt(lanes). A lane holds the
  sum of 2**31 windows; a text, at most 2**31 bytes long, has fewer.

Everything is DataFrame functions. A document's windows are summed in the task that
has the document: the data are shuffled once, by ranges of ``doc_id``, to find each
document's successor.

Defined results: a null text is empty; the successor of the last document is the
first, and a single document is its own; rows that repeat a ``doc_id`` follow one
another in the order of their texts; null ids come first. Likeness is 1 for equal
fingerprints, otherwise the cosine cut to 0..1, and 0 if one text has no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text

IDENTITY_LANES = 8
LIKENESS_LANES = 64
WINDOW = 3
_LOW = (1 << 32) - 1
_MODULUS = 1 << 32
#: Ranges of ids for each shuffle partition.
RANGES_PER_PARTITION = 4
_FIRST = -(1 << 63)


def _lanes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the arrays ``identity`` and ``likeness`` of each row's ``text``.

    ``texts`` must be partitioned by some of ``keys``, and rows differ in them: the sums
    then need no shuffle. The arrays are never empty; a plain explode would have them
    built once more to look.
    """
    paragraphs = texts.select(*keys, F.explode_outer(F.split("text", "\n", -1)).alias("paragraph"))
    words = paragraphs.select(
        *keys, "paragraph", F.filter(F.split("paragraph", r"\s+"), lambda w: w != "").alias("words")
    )
    count = F.size("words")
    hashes = F.when(count == 0, F.array(F.lit(None).cast("long"))).when(
        count <= WINDOW, F.array(F.xxhash64(F.concat_ws(" ", "words")))
    ).otherwise(
        F.transform(
            F.sequence(F.lit(0), count - WINDOW),
            lambda i: F.xxhash64(*(F.get("words", i + j) for j in range(WINDOW))),
        )
    )
    hashed = words.select(*keys, "paragraph", hashes.alias("hashes"))
    windows = hashed.select(*keys, "paragraph", F.posexplode_outer("hashes").alias("nth", "hash"))
    # The whole paragraph is hashed beside its first window: a hash gives two lanes.
    whole = [
        F.when(F.col("nth") == 0, F.xxhash64(F.lit(i), "paragraph"))
        for i in range(IDENTITY_LANES // 2)
    ]
    identity = [
        F.sum(F.shiftrightunsigned(whole[i // 2], 32 * (i % 2)).bitwiseAND(_lit(_LOW))).alias(f"i{i}")
        for i in range(IDENTITY_LANES)
    ]
    ones = [
        F.sum(F.shiftrightunsigned("hash", i).bitwiseAND(_lit(1))).alias(f"s{i}")
        for i in range(LIKENESS_LANES)
    ]
    sums = windows.groupBy(*keys).agg(*identity, *ones, F.count("hash").alias("n"))
    ones = F.array(*(F.coalesce(f"s{i}", _lit(0)) for i in range(LIKENESS_LANES)))
    return sums.select(
        *keys,
        F.transform(
            F.array(*(f"i{i}" for i in range(IDENTITY_LANES))), lambda x: x.bitwiseAND(_lit(_LOW))
        ).alias("identity"),
        F.transform(ones, lambda x: F.pmod(2 * x - F.col("n"), _lit(_MODULUS))).alias("likeness"),
    )


def _lit(number: int) -> Column:
    return F.lit(number).cast("long")


def _hex(lanes: Column, digits: int) -> Column:
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), digits, "0")), "")


def as_text(identity: Column, likeness: Column) -> Column:
    """A fingerprint in lowercase hexadecimal digits: identity lanes, then likeness lanes."""
    return F.lower(F.concat(_hex(identity, 8), _hex(likeness, 8)))


def combined(left: Column, right: Column, bits: int, sign: int = 1) -> Column:
    """Lanes of ``left`` with those of ``right`` inserted (``sign`` 1) or deleted (-1)."""
    return F.zip_with(left, right, lambda a, b: F.pmod(a + sign * b, _lit(1 << bits)))


def _signed(lanes: Column) -> Column:
    """Lanes as numbers around 0."""
    half = _MODULUS // 2
    return F.transform(
        lanes, lambda x: (F.pmod(x + half, _lit(_MODULUS)) - half).cast("double")
    )


def _dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def likeness(left: Column, right: Column) -> Column:
    """Likeness of two fingerprints: structs of identity and likeness lanes."""
    a, b = _signed(left["likeness"]), _signed(right["likeness"])
    sizes = F.sqrt(_dot(a, a) * _dot(b, b))
    cosine = F.when(sizes == 0, F.lit(0.0)).otherwise(_dot(a, b) / sizes)
    same = left["identity"] == right["identity"]
    return F.when(same, F.lit(1.0)).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def fingerprints(texts: DataFrame, key: str) -> DataFrame:
    """``key`` and ``fingerprint`` of the ``text`` of each row; ``key`` must be unique."""
    lanes = _lanes(texts.select(key, F.coalesce("text", F.lit("")).alias("text")), [key])
    return lanes.select(key, as_text(F.col("identity"), F.col("likeness")).alias("fingerprint"))


def _range_starts(docs: DataFrame, ranges: int) -> list[int]:
    """The first ids of at most ``ranges`` ranges of about as many rows; bounded by ``ranges``."""
    shares = F.array(*(F.lit(i / ranges) for i in range(ranges)))
    row = docs.agg(
        F.min("key").alias("first"), F.percentile_approx("key", shares, 10 * ranges).alias("starts")
    ).first()
    return sorted({row["first"], *(row["starts"] or [])}) if row["first"] is not None else []


def _range_of(key: Column, starts: list[int]) -> Column:
    """The place of the range that holds a key: two short searches instead of one long."""
    step = max(1, round(len(starts) ** 0.5))
    chunks = [starts[i : i + step] for i in range(0, len(starts), step)]
    table = F.array(*(F.array(*map(F.lit, chunk)).cast("array<long>") for chunk in chunks))
    heads = F.array(*(F.lit(chunk[0]) for chunk in chunks)).cast("array<long>")
    chunk = F.size(F.filter(heads, lambda s: s <= key)) - 1
    inner = F.size(F.filter(F.get(table, chunk), lambda s: s <= key)) - 1
    return chunk * step + inner


def _with_successors(docs: DataFrame, starts: list[int]) -> DataFrame:
    """``range``, ``place``, ``doc_id``, ``text`` and the next row's text, ``following``.

    The first row of the next range is appended to each range, as its last row with
    ``added`` true, so that ranges can be sorted apart from one another.
    """
    dealt = docs.withColumn("range", _range_of(F.col("key"), starts)).withColumn(
        "added", F.lit(False)
    )
    heads = (
        docs.where(F.col("key").isin(starts))
        .groupBy("key")
        .agg(F.min("text").alias("text"))
        .withColumn("range", _range_of(F.col("key"), starts))
        .select(
            "key",
            F.lit(None).cast("long").alias("doc_id"),
            "text",
            F.pmod(F.col("range") - 1, F.lit(len(starts))).alias("range"),
            F.lit(True).alias("added"),
        )
    )
    order = Window.partitionBy("range").orderBy("added", "key", "text")
    return dealt.unionByName(heads).select(
        "range",
        F.row_number().over(order).alias("place"),
        "doc_id",
        "added",
        "text",
        F.coalesce(F.lead("text").over(order), F.lit("")).alias("following"),
    )


def edited(text: Column, following: Column) -> Column:
    """The last quarter of a text's code points replaced by the first of the next text's."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - quarter),
        F.substring(following, F.lit(1), quarter),
    )


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    spark = docs.sparkSession
    rows = id_and_text(docs).withColumn("key", F.coalesce("doc_id", F.lit(_FIRST)))
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = _range_starts(rows, ranges) or [_FIRST]
    placed = _with_successors(rows, starts)
    both = placed.withColumn("edited", edited(F.col("text"), F.col("following"))).select(
        "range",
        "place",
        "doc_id",
        "added",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        F.explode_outer(
            F.array(
                F.struct(F.lit(False).alias("is_edited"), F.col("text")),
                F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text")),
            )
        ).alias("version"),
    )
    keys = ["range", "place", "doc_id", "added", "n_chars", "edited_sha256"]
    versions = _lanes(both.select(*keys, "version.*"), [*keys, "is_edited"])
    lanes = F.struct("identity", "likeness")
    pairs = versions.groupBy(*keys).agg(
        F.first(F.when(~F.col("is_edited"), lanes), ignorenulls=True).alias("own"),
        F.first(F.when(F.col("is_edited"), lanes), ignorenulls=True).alias("changed"),
    )
    order = Window.partitionBy("range").orderBy("place")
    known = pairs.withColumn("next", F.lead("own").over(order)).where(~F.col("added"))
    return known.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own.identity"), F.col("own.likeness")).alias("fingerprint"),
        as_text(F.col("changed.identity"), F.col("changed.likeness")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
