"""Document fingerprints: one-permutation MinHash with optimal densification.

Each shingle of five words is hashed once. The top bits of the hash choose one
of ``BINS`` bins, the smallest hash of a bin is its value. An empty bin borrows
from a filled one that a random order of its own picks (the filled bin with the
smallest hash of the two bin numbers), which is what probing by universal
hashing until a filled bin is met gives. Of each value the lowest eight bits are
kept. Two fingerprints agree in a bin with probability J + (1 - J) / 256, which
the estimate of J corrects for. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from netsift.llm.links import numbered_texts
from netsift.llm.text import SPACE
from netsift.session import scratch_dir

BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW_BITS = 8
SHINGLE = 5


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BIN_BITS).cast("int")


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda x: x != "")


def hashes_of(words: Column) -> Column:
    """Hash of each shingle, in order; that of all words where they are fewer than a shingle has."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1)))
    hashed = F.when(F.size(words) > 0, F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, SHINGLE))))
    return F.coalesce(hashed, F.array().cast("array<bigint>"))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: an array of the kept bits of all bins, empty for a text without words.

    A text of fewer than five words has one shingle, its whole word sequence.
    Null counts as empty.
    """
    words, hashes = f"_{name}_words", f"_{name}_shingles"
    hashed = df.withColumn(words, words_of(F.col(text))).withColumn(hashes, hashes_of(F.col(words)))
    return binned(hashed, hashes, name).drop(words, hashes)


def binned(df: DataFrame, hashes: str, name: str) -> DataFrame:
    """Add the fingerprint ``name`` out of the shingle hashes in column ``hashes``."""
    h, f, b = (f"_{name}_{part}" for part in ("hashes", "firsts", "bins"))
    sorted_ = df.withColumn(h, F.sort_array(hashes))
    # Sorted by hash, the values of a bin stand together and its smallest comes first.
    first = F.filter(
        F.col(h), lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(F.col(h), i - 1)))
    )
    grouped = sorted_.withColumn(f, first).drop(h).withColumn(b, F.transform(f, _bin))
    low, high = (F.lit(v).cast("bigint") for v in (BINS - 1, -BINS))

    def borrowed(j: Column) -> Column:
        order = F.transform(
            F.col(b), lambda x, i: F.xxhash64(j, x).bitwiseAND(high).bitwiseOR(i.cast("bigint"))
        )
        return F.array_min(order).bitwiseAND(low).cast("int")

    def value(j: Column) -> Column:
        own = F.array_position(F.col(b), j).cast("int")
        return F.get(F.col(f), F.when(own > 0, own - 1).otherwise(borrowed(j)))

    full = (
        F.when(F.size(f) == BINS, F.col(f))
        .when(F.size(f) == 0, F.array().cast("array<bigint>"))
        .otherwise(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value))
    )
    kept = F.transform(full, lambda x: x.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint")).cast("smallint"))
    return grouped.withColumn(name, kept).drop(f, b)


def packed(fingerprint: Column) -> Column:
    """The kept bits as lower-case hexadecimal digits."""
    digits = F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), LOW_BITS // 4, "0"))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness, corrected for chance agreement; 1 for two empty texts, 0 for one."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / float(BINS)
    chance = 2.0**-LOW_BITS
    estimate = F.greatest((same - chance) / (1 - chance), F.lit(0.0))
    return (
        F.when(F.size(a) + F.size(b) == 0, 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(F.coalesce(estimate, F.lit(0.0)))
    )


def neighbours(ids: DataFrame, purpose: str = "order") -> DataFrame:
    """The id before each id in ascending order (before the first: the last), with that id's ``n``.

    ``ids`` holds distinct ``doc_id`` and ``n``. Ids are sorted by range; only
    the first and last id of each range meet in one task.
    """
    spark = ids.sparkSession
    path = scratch_dir(spark, purpose)
    # Written once, since ranges are found by sampling and would differ between two uses.
    ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    ends = ranged.groupBy("part").agg(
        F.max("doc_id").alias("last"), F.max_by("n", "doc_id").alias("last_n"), F.min("doc_id").alias("first")
    )
    over = Window.orderBy("part")
    final = ends.agg(F.max_by("last", "part").alias("l"), F.max_by("last_n", "part").alias("ln")).first()
    before = ends.select(
        F.col("first").alias("doc_id"), F.coalesce(F.lag("last").over(over), F.lit(final["l"])).alias("_p"),
        F.coalesce(F.lag("last_n").over(over), F.lit(final["ln"])).alias("_n"),
    )
    within = Window.partitionBy("part").orderBy("doc_id")
    lagged = ranged.select(
        "doc_id", F.lag("doc_id").over(within).alias("prev_id"), F.lag("n").over(within).alias("prev_n")
    )
    return lagged.join(before, "doc_id", "left").select(
        "doc_id", F.coalesce("prev_id", "_p").alias("prev_id"), F.coalesce("prev_n", "_n").alias("prev_n")
    )


def edited_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has the last floor(n / 4) of its n code points replaced by
    as many (or all) of the first ones of the next document in ascending id; the
    first follows the last. Columns: doc_id, n_chars, edited, fingerprint,
    edited_fingerprint (arrays), near_edited, near_next. Null texts are empty.
    Rows that repeat an id keep a row each; to others they count as one document
    with the smallest of their texts' beginnings. A null id has no next
    document: nothing is put in place and near_next is 0.

    Texts are shuffled once by id, and their beginnings once to the document
    before.
    """
    rows = numbered_texts(docs, id_column, text_column)
    numbered = rows.filter("doc_id is not null")
    ids = numbered.groupBy("doc_id").agg(F.coalesce(F.max(F.length("text")), F.lit(0)).alias("n"))
    order = neighbours(ids)
    # Both joins below read this one exchange. Null ids or lambda functions in it would make two different ones of
    # it, so a document's fingerprint is computed behind the exchange, for itself and for the document before.
    dealt = numbered.repartition("doc_id")
    heads = (
        with_fingerprint(dealt.join(order, "doc_id"), "text", "fingerprint")
        .select(
            F.col("prev_id").alias("doc_id"),
            F.struct(
                F.expr("coalesce(substring(text, 1, int(prev_n div 4)), '')").alias("head"), F.col("fingerprint").alias("next")
            ).alias("found"),
        )
        .groupBy("doc_id")
        .agg(F.min("found").alias("found"))
        .select("doc_id", "found.head", "found.next")
    )
    text = F.expr(
        "concat(substring(text, 1, n_chars - n_chars div 4),"
        " coalesce(substring(head, 1, int(n_chars div 4)), ''))"
    )
    both = (
        dealt.join(heads, "doc_id", "left")
        .unionByName(rows.filter("doc_id is null"), allowMissingColumns=True)
        .withColumn("text", F.coalesce("text", F.lit("")))
        .withColumn("n_chars", F.length("text"))
        .withColumn("edited", text)
    )
    # All but the last of the words that stay are the edited text's as well, and so are the shingles within them.
    stay = F.regexp_count(F.expr("substring(text, 1, n_chars - n_chars div 4)"), F.lit("[^" + SPACE[1:] + "+"))
    both = (
        both.withColumn("words", words_of(F.col("text")))
        .withColumn("hashes", hashes_of(F.col("words")))
        .withColumn("same", F.greatest(stay - SHINGLE, F.lit(0)))
        .withColumn("other", words_of(F.col("edited")))
        .withColumn("other", F.slice("other", F.col("same") + 1, F.greatest(F.size("other"), F.lit(1))))
        .withColumn("changed", F.concat(F.slice("hashes", F.lit(1), F.col("same")), hashes_of(F.col("other"))))
    )
    done = binned(binned(both, "hashes", "fingerprint"), "changed", "edited_fingerprint")
    return done.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        F.coalesce(likeness(F.col("fingerprint"), F.col("next")), F.lit(0.0)).alias("near_next"),
    )
