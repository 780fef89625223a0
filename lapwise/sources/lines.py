"""Text lines of CSV files with lineage, split into good records and rejects.

Files are read as plain text, so that a record can be judged before it is parsed:
Spark's own corrupt-record column also fires on a mere difference in column count,
which this layer tolerates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapwise.session import stored
from lapwise.sources.entities import Entity

# Tokens read as NULL.
NULL_TOKENS = ("\\N", "N", "", "NULL", "null")

# A comma-separated record whose quoted fields are closed.
_QUOTED = r'\s*+"[^"]*+(?:""[^"]*+)*+"\s*+'
_BARE = r'(?!\s*+")[^,]*+'
_FIELD = rf"(?:{_QUOTED}|{_BARE})"
RECORD_PATTERN = rf"^{_FIELD}(?:,{_FIELD})*+$"
SOUND_START = rf"^(?:{_FIELD},)*+"

# A line that ends inside a quoted field, and lines that start inside one and stay
# there or close the record.
_TEXT = r'[^"]*+(?:""[^"]*+)*+'
_OPENS = rf'^(?:{_FIELD},)*+\s*+"{_TEXT}$'
_STAYS = rf'^{_TEXT}(?:"\s*+,(?:{_FIELD},)*+\s*+"{_TEXT})?+$'
_CLOSES = rf'^{_TEXT}"\s*+(?:,{_FIELD})*+$'

CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
}

# Consecutive lines of a file that meet the runs among them in one task.
CHUNK_LINES = 10_000

SPLIT = ["file_path", "block_start"]
UNCLOSED_QUOTE = "unclosed or misplaced quote"


def with_lineage(lines: DataFrame) -> DataFrame:
    """Plain text lines plus the file facts needed later; works on streams as well."""
    return lines.select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def read_lines(
    spark: SparkSession, paths: str | list[str], pattern: str | None = None
) -> DataFrame:
    """Lines of every file under ``paths``; gzip is read transparently.

    ``pattern`` must match the whole stored path, compressed suffix included.
    """
    lines = with_lineage(spark.read.option("recursiveFileLookup", "true").text(paths))
    return lines if pattern is None else lines.filter(F.col("file_path").rlike(pattern))


def scanned(lines: DataFrame) -> tuple[DataFrame, int]:
    """The lines, read once and stored, with what each does to an open quoted field.

    Also how many lines open one, which is counted on the way.

    ``place`` rises within the lines of one scan split.  ``opens`` says that a line read from a
    record's start ends inside a quoted field; ``within`` says what it does when it starts
    inside one: ``stay`` there, ``close`` the record soundly, or ``break`` it.
    """
    value = F.col("value")
    quoted = value.contains('"')
    seen = Observation()
    scan = lines.select(
        "value", "file_path", "file_modified", "block_start",
        F.monotonically_increasing_id().alias("place"),
        (quoted & value.rlike(_OPENS)).alias("opens"),
        F.when(~quoted | value.rlike(_STAYS), "stay")
        .when(value.rlike(_CLOSES), "close")
        .otherwise("break")
        .alias("within"),
    ).observe(seen, F.count_if(F.col("opens")).alias("opening"))
    return stored(scan, "lines"), seen.get["opening"]


def _inside_before(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``known`` and ``odd``: the state before each row as far as its group tells.

    A row either ``sets`` whether a field is open, or ``flips`` that, or leaves it.  ``known`` is
    the state if a row before sets it, else NULL; ``odd`` whether the flips before are odd.
    """
    before = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    counted = rows.withColumn(
        "flipped", F.coalesce(F.sum(F.col("flips").cast("bigint")).over(before), F.lit(0))
    )
    setting = F.when(F.col("sets").isNotNull(), F.struct("sets", "flipped"))
    last = F.last(setting, ignorenulls=True).over(before)
    return counted.withColumn("last", last).select(
        *rows.columns,
        (F.col("last.sets") != ((F.col("flipped") - F.col("last.flipped")) % 2 == 1)).alias("known"),
        (F.col("flipped") % 2 == 1).alias("odd"),
    )


def _moves(scan: DataFrame) -> DataFrame:
    """Lines that change or may end an open field, without text, with the state before each."""
    opens, within = F.col("opens"), F.col("within")
    flips = opens & (within == "close")
    moving = scan.filter(opens | (within != "stay")).select(
        *SPLIT, "place", "opens", "within",
        F.when(~flips, opens).alias("sets"), flips.alias("flips"),
    )
    return _inside_before(moving, SPLIT, "place")


def split_counts(scan: DataFrame) -> DataFrame:
    """One row per scan split: its first place, the lines of the file before it, the file's number."""
    counts = scan.groupBy(*SPLIT).agg(F.min("place").alias("first"), F.count("*").alias("lines"))
    own = W.partitionBy("file_path")
    earlier = own.orderBy("block_start").rowsBetween(W.unboundedPreceding, -1)
    return counts.select(
        *SPLIT, "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"),
        F.min("first").over(own).alias("file"),
    )


def split_states(scan: DataFrame, splits: DataFrame) -> DataFrame:
    """The splits with ``inside``: whether they start inside a quoted field.

    Each split sums up what it does to an open field by itself; the sums of the splits before
    it in the file give its start.
    """
    end = _moves(scan).groupBy(*SPLIT).agg(
        F.max_by(F.coalesce("sets", F.col("known") != F.col("flips")), "place").alias("sets"),
        F.max_by(F.col("odd") != F.col("flips"), "place").alias("odd_flips"),
    )
    effect = end.select(*SPLIT, "sets", (F.col("sets").isNull() & F.col("odd_flips")).alias("flips"))
    moved = splits.join(effect, SPLIT, "left").fillna(False, ["flips"])
    return _inside_before(moved, ["file_path"], "block_start").select(
        *splits.columns, F.coalesce("known", "odd").alias("inside")
    )


def joined_records(scan: DataFrame, splits: DataFrame) -> DataFrame:
    """``file, from_line, to_line`` of every record that runs over several lines.

    A record that opens a quoted field goes on to the line that closes it soundly.  Where a
    line breaks the field, or none closes it, no lines are joined and each is judged alone.
    """
    inside = F.coalesce("known", F.col("odd") != F.col("inside"))
    states = _moves(scan).join(splits, SPLIT)
    events = states.withColumn("in", inside).select(
        *SPLIT, (F.col("before") + F.col("place") - F.col("first") + 1).alias("line"),
        (F.col("opens") & (~F.col("in") | (F.col("within") == "break"))).alias("starts"),
        (F.col("in") & (F.col("within") == "close")).alias("ends"),
        (F.col("in") & (F.col("within") == "break")).alias("breaks"),
    ).filter("starts or ends or breaks")
    following = W.partitionBy(*SPLIT).orderBy("line")
    event = F.struct("line", "ends")
    own = events.withColumn("next", F.lead(event).over(following))
    # A split's last event is followed by the first one of a later split.
    later = W.partitionBy("file_path").orderBy("block_start").rowsBetween(1, W.unboundedFollowing)
    firsts = (
        splits.select(*SPLIT, "file")
        .join(events.groupBy(*SPLIT).agg(F.min_by(event, "line").alias("first_event")), SPLIT, "left")
        .select(*SPLIT, "file", F.first("first_event", ignorenulls=True).over(later).alias("after"))
    )
    return (
        own.filter("starts").join(firsts, SPLIT)
        .withColumn("next", F.coalesce("next", "after"))
        .filter("next.ends")
        .select("file", F.col("line").alias("from_line"), F.col("next.line").alias("to_line"))
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Add the 1-based line number within the file."""
    scan, _ = scanned(lines)
    return _numbered(scan, stored(split_counts(scan), "splits")).drop("file")


def _numbered(scan: DataFrame, splits: DataFrame) -> DataFrame:
    # Joined on the split, unhinted: Spark broadcasts the stored splits while they are small.
    return scan.join(splits, SPLIT).select(
        "value", "file_path", "file_modified", "file",
        (F.col("before") + F.col("place") - F.col("first") + 1).alias("line_number"),
    )


def _with_run(numbered: DataFrame, runs: DataFrame) -> DataFrame:
    """The lines with ``from_line``, the first line of the run they are in, else NULL.

    Lines and runs meet in chunks of a file, which each run enters once: nothing has a row for
    every line of a run, so there is nothing that Spark could take for small and broadcast.
    """

    def chunk(line: str) -> Column:
        return F.floor((F.col(line) - 1) / CHUNK_LINES)

    run = F.struct("from_line", "to_line")
    entered = runs.select(
        "file", run.alias("run"), "from_line", F.explode(F.sequence(chunk("from_line"), chunk("to_line"))).alias("chunk")
    ).select(
        "file", "chunk", "run", F.greatest("from_line", F.col("chunk") * CHUNK_LINES + 1).alias("line_number")
    )
    both = numbered.withColumn("chunk", chunk("line_number")).unionByName(entered, allowMissingColumns=True)
    # A frame by value takes the run that enters at the line itself along.
    upto = W.partitionBy("file", "chunk").orderBy("line_number")
    latest = both.withColumn("latest", F.last("run", ignorenulls=True).over(upto)).filter(F.col("run").isNull())
    inside = F.col("latest.to_line") >= F.col("line_number")
    return latest.select(*numbered.columns, F.when(inside, F.col("latest.from_line")).alias("from_line"))


def read_records(lines: DataFrame) -> DataFrame:
    """Records with the number of their first line; a line break inside quotes is kept as ``\\n``.

    The text is read once.  Whether a split starts inside a quoted field follows from
    the quotes of the splits before it, so every split finds its records by itself.  Only
    lines of records that run over several lines are gathered, record by record.
    """
    scan, opening = scanned(lines)
    splits = stored(split_counts(scan), "splits")
    numbered = _numbered(scan, splits)
    if not opening:
        return numbered.drop("file")
    runs = stored(joined_records(scan, split_states(scan, splits)), "runs")
    marked = _with_run(numbered, runs)
    whole = (
        marked.filter("from_line is not null")
        .groupBy("file", F.col("from_line").alias("line_number"))
        .agg(
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("line_number", "value"))), lambda x: x["value"]),
                "\n",
            ).alias("value"),
            F.first("file_path").alias("file_path"),
            F.max("file_modified").alias("file_modified"),
        )
    )
    alone = marked.filter("from_line is null").drop("from_line")
    return alone.unionByName(whole).select("value", "file_path", "file_modified", "line_number")


def judged(lines: DataFrame, header_lines: int = 1) -> DataFrame:
    """Records (no header, no blank lines) with the reason for rejection, if any."""
    value = F.col("value")
    return (
        read_records(lines)
        .filter((F.col("line_number") > header_lines) & (F.trim(value) != ""))
        .withColumn(
            "error",
            F.when(~value.rlike(RECORD_PATTERN), F.lit(UNCLOSED_QUOTE)),
        )
    )


def parse(records: DataFrame, entity: Entity, keep_tokens: bool = False) -> DataFrame:
    """First columns by position as text: short records are padded with NULL, long ones cut.

    ``keep_tokens`` leaves the NULL tokens as they are written.  A record with more fields
    is cut before it is parsed, so no number of surplus fields is too many for the parser.
    """
    value, wanted = F.col("value"), len(entity.landing)
    first = F.regexp_extract(value, rf"^{_FIELD}(?:,{_FIELD}){{{wanted - 1}}}", 0)
    commas = F.length(value) - F.length(F.replace(value, F.lit(","), F.lit("")))
    kept = F.when((commas >= wanted) & (first != ""), first).otherwise(value)
    fields = F.from_csv(kept, entity.landing_schema.toDDL(), CSV_OPTIONS)
    parsed = records.withColumn("__fields", fields)

    def cell(name: str) -> F.Column:
        text = F.col(f"__fields.`{name}`")
        return text if keep_tokens else F.when(~text.isin(*NULL_TOKENS), text)

    others = [c for c in records.columns if c != "value"]
    return parsed.select(*[cell(c).alias(c) for c in entity.landing], *others)


def landed(records: DataFrame, entity: Entity, loaded_at) -> DataFrame:
    """Landing rows of an entity: text columns and the four lineage columns."""
    return parse(records, entity).select(
        *entity.landing,
        F.col("file_path").alias("dw_file_name"),
        (F.col("line_number") - 1).alias("dw_file_row_number"),
        F.col("file_modified").alias("dw_file_last_modified"),
        F.lit(loaded_at).cast("timestamp").alias("dw_loaded_at"),
    )


def rejects(records: DataFrame, entity: Entity, recorded_at) -> DataFrame:
    """Rejected records; ``character_pos`` is where the first unsound field begins, from 1."""
    return records.filter(F.col("error").isNotNull()).select(
        F.lit(entity.name).alias("target_table"),
        F.col("error").alias("error_message"),
        F.col("file_path").alias("file_name"),
        "line_number",
        (F.length(F.regexp_extract("value", SOUND_START, 0)) + 1)
        .cast("bigint")
        .alias("character_pos"),
        F.col("value").alias("rejected_record"),
        F.lit(recorded_at).cast("timestamp").alias("recorded_at"),
    )
