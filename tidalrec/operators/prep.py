"""Column preparation: prefixes, buckets, year / title parsing, dates, ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalrec.operators import split as S
from tidalrec.operators.skew import lookup_join
from tidalrec.sources.tables import stored

# ---- fixed values (must equal the reference's labels) -------------------------------
# age bucket edges, left-closed: [0,18) [18,25) [25,35) [35,45) [45,55) [55,65) [65,200)
AGE_EDGES = [0, 18, 25, 35, 45, 55, 65, 200]
AGE_LABELS = ["age_0_17", "age_18_24", "age_25_34", "age_35_44", "age_45_54", "age_55_64", "age_65_plus"]
YEAR_PATTERN = r"\((\d{4})\)"
TITLE_YEAR_PATTERN = r"\s\(\d{4}\)"
RARE_LABEL = "other"
ZIP_DEFAULT = "000"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def prefixed(x, prefix: str) -> Column:
    """'<prefix><value as text>' (e.g. age_25.0, occ_4)."""
    return F.concat(F.lit(prefix), _c(x).cast("string"))


def leading_bucket(x, n: int = 3, default: str = ZIP_DEFAULT) -> Column:
    """First ``n`` characters; a missing value becomes ``default``."""
    return F.coalesce(F.substring(_c(x).cast("string"), 1, n), F.lit(default))


def range_bucket(x, edges: list[float] = AGE_EDGES, labels: list[str] = AGE_LABELS) -> Column:
    """Left-closed labelled ranges; outside [edges[0], edges[-1]) -> NULL."""
    v = _c(x).cast("double")
    out = F.lit(None).cast("string")
    for lo, hi, lab in reversed(list(zip(edges[:-1], edges[1:], labels))):
        out = F.when((v >= lo) & (v < hi), F.lit(lab)).otherwise(out)
    return out


def year_of_title(title) -> Column:
    """First '(dddd)' in the title as INT, NULL when absent."""
    y = F.regexp_extract(_c(title), YEAR_PATTERN, 1)
    return F.when(y == "", F.lit(None)).otherwise(y).cast("int")


def decade_bucket(year) -> Column:
    y = _c(year)
    return F.when(y.isNull(), F.lit("year_unknown")).otherwise(
        F.concat(F.lit("year_"), (F.floor(y / 10) * 10).cast("bigint").cast("string"), F.lit("s")))


def clean_title(title) -> Column:
    """Remove every ' (dddd)'."""
    return F.regexp_replace(_c(title).cast("string"), TITLE_YEAR_PATTERN, "")


def epoch_to_date(epoch_seconds) -> Column:
    return F.date_format(F.timestamp_seconds(_c(epoch_seconds).cast("bigint")), "yyyy-MM-dd")


def surrogate_id(prefix: str, idx, n: int) -> Column:
    """'<prefix>_<idx zero padded to max(6, digits(n))>'; a longer idx stays whole."""
    width = max(6, len(str(int(n))))
    text = _c(idx).cast("string")
    return F.concat(F.lit(prefix + "_"), F.lpad(text, F.greatest(F.lit(width), F.char_length(text)), "0"))


def fold_rare(df: DataFrame, col: str, out: str, min_count_exclusive: int = 10) -> DataFrame:
    """Keep a value when its count in the table is > threshold, else 'other'.
    Counts are one aggregate joined back on the value (no wide window), by their bytes and the values' shares."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    keep = counts.filter(F.col("_n") > min_count_exclusive).select(col, F.lit(True).alias("_keep"))
    return (lookup_join(df, keep, col)
            .withColumn(out, F.when(F.col("_keep"), F.col(col)).otherwise(F.lit(RARE_LABEL)))
            .drop("_keep"))


# ---- ratings-style preparation (text source -> four tables) -------------------------

def prepare_users(raw: DataFrame) -> DataFrame:
    """raw: user_id, gender, age, occupation, zip (text)."""
    return raw.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.expr("try_cast(age AS DOUBLE)").alias("age"),
        F.col("gender").cast("string").alias("gender"),
        prefixed(F.expr("try_cast(age AS DOUBLE)"), "age_").alias("age_group"),
        prefixed("occupation", "occ_").alias("occupation"),
        F.col("zip").cast("string").alias("zip"),
        leading_bucket("zip").alias("zip_prefix"))


def prepare_items(raw: DataFrame) -> DataFrame:
    """raw: item_id, title, genres (text)."""
    x = fold_rare(raw, "genres", "genre_grouped")
    y = year_of_title("title")
    return x.select(F.col("item_id").cast("string").alias("item_id"), "genres", "genre_grouped", "title",
                    clean_title("title").alias("title_raw"), y.cast("string").alias("year"),
                    decade_bucket(y).alias("year_bucket"))


@dataclass
class Prepared:
    """The four tables of a prepared data set, and the lines that are in none of them."""
    users: DataFrame
    items: DataFrame
    train: DataFrame
    val: DataFrame
    rejected: DataFrame  # source, reason, line


def _judged(raw: DataFrame, line: str, checks: list[tuple[Column, str]]) -> DataFrame:
    """Every row with its ``reason`` (null: good; the first check that holds names it); good rows keep their fields,
    others their line."""
    reason = F.lit(None).cast("string")
    for bad, text in reversed(checks):
        reason = F.when(bad, F.lit(text)).otherwise(reason)
    good = F.col("reason").isNull()
    return raw.withColumn("reason", reason).select(
        *(F.when(good, F.col(c)).alias(c) for c in raw.columns if c != line), F.when(~good, F.col(line)).alias(line), "reason")


def _told_apart(judged: DataFrame, line: str, source: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected(source, reason, line))."""
    return (judged.where("reason is null").drop("reason", line),
            judged.where("reason is not null").select(F.lit(source).alias("source"), "reason", F.col(line).alias("line")))


def _absent(c: str) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


def _not(kind: str, c: str) -> Column:
    return F.expr(f"try_cast({c} AS {kind}) IS NULL")


def _judge_users(raw: DataFrame, line: str) -> DataFrame:
    return _judged(raw, line, [
        (~F.col("complete"), "wrong number of fields"), (_absent("user_id"), "no user id"),
        (~_absent("age") & _not("DOUBLE", "age"), "age is not a number")])


def _judge_items(raw: DataFrame, line: str) -> DataFrame:
    return _judged(raw, line, [(~F.col("complete"), "wrong number of fields"), (_absent("item_id"), "no item id")])


def _judge_ratings(raw: DataFrame, line: str) -> DataFrame:
    number = F.expr("try_cast(rating AS DOUBLE)")
    return _judged(raw, line, [
        (~F.col("complete"), "wrong number of fields"), (_absent("user_id"), "no user id"), (_absent("item_id"), "no item id"),
        (number.isNull() | F.isnan(number) | (F.abs(number) == float("inf")), "rating is not a number"),
        (_not("BIGINT", "timestamp"), "time is not a whole number")])


def split_users(raw: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """Raw users told apart; an absent age is allowed, one that isn't a number is not."""
    return _told_apart(_judge_users(raw, line), line, "users")


def split_items(raw: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    return _told_apart(_judge_items(raw, line), line, "items")


def split_ratings(raw: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """Raw ratings told apart; a rating may be any finite number, a time is whole seconds since the epoch."""
    return _told_apart(_judge_ratings(raw, line), line, "ratings")


def prepare_all(users: DataFrame, items: DataFrame, ratings: DataFrame, val_t: float = 0.2) -> Prepared:
    """users, items, train and val from raw text rows with ``line`` and ``complete`` (see ``read_lines``).

    Every line is in exactly one of the five tables.  Lines are parsed and judged once: the judged rows are written
    under the checkpoint folder, and all tables and the split's bounds are read from there.
    """
    u, bad_u = _told_apart(stored(_judge_users(users, "line"), "judged"), "line", "users")
    i, bad_i = _told_apart(stored(_judge_items(items, "line"), "judged"), "line", "items")
    rows, bad_r = _told_apart(stored(prepare_ratings(_judge_ratings(ratings, "line"), "line", "reason"), "judged"), "line", "ratings")
    train, val = S.split_at(rows, "timestamp", S.split_threshold(rows, "timestamp", val_t))
    return Prepared(prepare_users(u), prepare_items(i), train, val, bad_u.unionByName(bad_i).unionByName(bad_r))


def prepare_ratings(raw: DataFrame, *more: str) -> DataFrame:
    """raw: user_id, item_id, rating, epoch seconds; ``more``: columns that are carried along."""
    return raw.select(F.col("user_id").cast("string").alias("user_id"),
                      F.col("item_id").cast("string").alias("item_id"),
                      F.expr("try_cast(rating AS DOUBLE)").alias("rating"),
                      epoch_to_date(F.expr("try_cast(timestamp AS BIGINT)")).alias("timestamp"), *more)
