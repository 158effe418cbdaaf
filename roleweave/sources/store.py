"""The postings table as appended changes, and the run log, on plain Parquet.

A batch appends one row for each of its URLs and nothing else: what the first sighting fixed (only where the URL is
new), and what the feed says now. Scores, statuses, descriptions and recomputed flags are appended in the same way.
Reading takes, for each URL, the newest value of each part in one aggregate with a map-side half, so a URL with very
many changes is reduced before the shuffle. A write reads no text: new URLs are told from known ones by the URL column of
first sightings. `compacted` writes the current rows as one table, an ordinary job to run now and then.

Each write has a number, its place in the order of arrival, and its row in the log, appended last; changes beyond
the last number of the log are those of a write that broke off, are not read, and the next write replaces them. A batch
key that is in the log is not applied again. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roleweave.functions.classify import RelevanceRules
from roleweave.functions.text import is_empty_description
from roleweave.operators.upsert import ONCE, assign_ids, collapse
from roleweave.operators.triage import pending_score
from roleweave.schemas import RUN, SNAPSHOT_COLUMNS
from roleweave.session import byte_size, fits_broadcast, stage

# One row for each write. `source` is set for runs of a source, `number` for whatever stored something.
LOG = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("batch_key", T.StringType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("run_id", T.LongType()),
        *[f for f in RUN.fields if f.name != "id"],
    ]
)

# What one write says about one URL. A part that is null says nothing.
_ONCE = "id: bigint, raw_id: string, source: string, company: string, posted_date: date, extra_json: string, first_seen_at: timestamp"
CHANGE = (
    f"url string, first struct<{_ONCE}>, seen struct<title: string, location: string, last_seen_at: timestamp>, "
    "description struct<value: string>, is_relevant struct<value: boolean>, is_remote struct<value: int>, "
    "score double, status struct<value: string, changed_at: timestamp>, number bigint, kind string"
)
PARTS = ("seen", "description", "is_relevant", "is_remote")

# Payloads that were dropped as malformed, by run.
REJECT = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("landed", T.StringType()),
        T.StructField("rejected_at", T.TimestampType()),
    ]
)


class BatchRejected(ValueError):
    """A row of the batch lacks a required value; nothing was stored."""


def newest(changes: DataFrame) -> DataFrame:
    """Current postings: for each URL that was sighted, the newest value of each part.

    A status is newer by its time, then by its place. URLs without a sighting are not postings.
    """
    last = [F.max_by(p, F.when(F.col(p).isNotNull(), F.col("number"))).alias(p) for p in (*PARTS, "score")]
    order = F.when(F.col("status").isNotNull(), F.struct(F.col("status.changed_at").alias("at"), "number"))
    first = F.min_by("first", F.when(F.col("first").isNotNull(), F.col("number"))).alias("first")
    rows = changes.groupBy("url").agg(first, *last, F.max_by("status", order).alias("status")).where("first is not null")
    columns = {
        **{name: F.col(f"first.{name}") for name in ("id", "first_seen_at", *ONCE)},
        **{name: F.col(f"seen.{name}") for name in ("title", "location", "last_seen_at")},
        **{name: F.col(f"{name}.value") for name in ("description", "is_relevant", "is_remote")},
        "application_status": F.coalesce("status.value", F.lit("new")),
        "application_status_updated_at": F.col("status.changed_at"),
    }
    return rows.select("url", "score", *[c.alias(name) for name, c in columns.items()]).select(*SNAPSHOT_COLUMNS)


class PostingStore:
    """Changes, log and rejects under one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ reading

    def log(self) -> DataFrame:
        """One row for each write and each failed run."""
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.root}/log")
        except AnalysisException:  # nothing was written yet
            return self.spark.createDataFrame([], LOG)

    def changes(self, *kinds: str) -> DataFrame:
        """All changes up to the last logged write, or those of some kinds: first, seen, score, status, description, flags."""
        return self._upto(self._last().number, kinds)

    def _upto(self, number: int, kinds: tuple[str, ...]) -> DataFrame:
        if not number:
            return self.spark.createDataFrame([], CHANGE)
        rows = self.spark.read.schema(CHANGE).parquet(f"{self.root}/changes").where(F.col("number") <= number)
        return rows.where(F.col("kind").isin(*kinds)) if kinds else rows

    def _last(self) -> Row:
        """Number of the last write, and the greatest posting id and run id."""
        greatest = [F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("number", "last_id", "run_id")]
        return self.log().agg(*greatest).first()

    def read(self) -> DataFrame:
        """Current postings."""
        return newest(self.changes())

    def known(self) -> DataFrame:
        """(url) of every posting: the URL column of first sightings."""
        return self.changes("first").select("url")

    def runs(self) -> DataFrame:
        """The run log. A run that stored something is logged by the row that makes its changes visible."""
        return self.log().where("run_id is not null").select(F.col("run_id").alias("id"), *RUN.fieldNames()[1:])

    def rejects(self) -> DataFrame:
        """Malformed payloads that ingest dropped."""
        try:
            return self.spark.read.schema(REJECT).parquet(f"{self.root}/rejects")
        except AnalysisException:  # nothing was dropped yet
            return self.spark.createDataFrame([], REJECT)

    def _batch(self, batch_key: str) -> DataFrame:
        return self.log().where(F.col("batch_key") == batch_key)

    def has_batch(self, batch_key: str) -> bool:
        return not self._batch(batch_key).isEmpty()

    def pending_of(self, batch_key: str) -> DataFrame:
        """(url, description) of what a batch left to score: its own relevant postings with a text, unless they have a score.

        Reads the changes of that batch, and the URL column of the scores.
        """
        found = self._batch(batch_key).select("number").first()
        number = found.number if found is not None and found.number is not None else -1
        own = self.changes("first", "seen").where((F.col("number") == number) & F.col("description").isNotNull())
        rows = own.select("url", F.col("description.value").alias("description"), F.col("is_relevant.value").alias("is_relevant"))
        scored = self.changes("score").select("url").distinct()
        return pending_score(rows.withColumn("score", F.lit(None).cast("double"))).join(scored, "url", "left_anti")

    # ------------------------------------------------------------ writing

    def _append(self, rows: DataFrame, **entry) -> int:
        """Write changes (with their kind) and then their row of the log; returns the number of the write."""
        last = self._last()
        number = last.number + 1
        parts = {name: rows[name] if name in rows.columns else F.lit(None).cast(kind) for name, kind in _types().items()}
        out = rows.select(*[c.cast(_types()[name]).alias(name) for name, c in parts.items() if name != "number"])
        # Files of even size, whatever kinds the batch has. The same number is written again only if it was never logged.
        out.hint("rebalance", "kind").write.mode("overwrite").partitionBy("kind").parquet(f"{self.root}/changes/number={number}")
        self._note(**({"number": number, "last_id": last.last_id} | entry))
        return number

    def _note(self, **entry) -> None:
        row = Row(**{name: entry.get(name) for name in LOG.fieldNames()})
        self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def _run_entry(self, source: str | None, started_at: datetime | None, stats: Row | None, error: str | None = None) -> dict:
        counts = stats.asDict() if stats is not None else {}
        run = dict(run_id=self._last().run_id + 1, source=source, started_at=started_at, finished_at=datetime.now(timezone.utc), error=error)
        return counts | (run if source is not None else {})

    def upsert(
        self,
        batch: DataFrame,
        rules: RelevanceRules,
        now: datetime | Column | None = None,
        batch_key: str | None = None,
        keep_filled_descriptions: bool = False,
        run: tuple[str, datetime] | None = None,
    ) -> Row:
        """Apply a batch of normalized postings; returns its run statistics.

        With `run`, its source and start, the run is logged by the row that makes the changes visible. A batch key that is
        known is neither applied nor logged again. Written are the rows of the batch alone.
        """
        if batch_key is not None:
            earlier = self._batch(batch_key).select("fetched_count", "new_count", "updated_count").first()
            if earlier is not None:
                return earlier
        arrivals = stage(collapse(batch, rules), "arrivals")
        measured = arrivals.agg(
            byte_size(arrivals.select("url", "first_arrival")).alias("bytes"),
            F.coalesce(F.sum("occurrences"), F.lit(0)).alias("fetched"),
            F.max(F.when(F.col("broken") > 0, F.coalesce("url", F.lit("null")))).alias("broken_url"),
        ).first()
        if measured.broken_url is not None:
            raise BatchRejected(f"a required value is missing for url {measured.broken_url!r}")
        last_id = self._last().last_id
        keys = arrivals.select("url", "first_arrival")
        # Stored URLs stay where they are if the batch's own are few.
        own = F.broadcast(keys) if fits_broadcast(measured.bytes) else keys
        fresh = stage(keys.join(self.known().join(own, "url", "left_semi"), "url", "left_anti"), "fresh")
        new = fresh.count()
        stats = Row(fetched_count=measured.fetched, new_count=new, updated_count=measured.fetched - new)
        entry = self._run_entry(*(run or (None, None)), stats) | {"batch_key": batch_key}
        if not measured.fetched:
            self._note(**entry)
            return stats
        stamp = now if isinstance(now, Column) else F.lit(now or datetime.now(timezone.utc)).cast("timestamp")
        ids = assign_ids(fresh, last_id, staged=True)
        is_new, text = F.col("new_id").isNotNull(), F.col("latest.description")
        first = F.struct(F.col("new_id").alias("id"), *[F.col(f"once.{c}").alias(c) for c in ONCE], stamp.alias("first_seen_at"))
        kept = ~is_new & is_empty_description(text) if keep_filled_descriptions else F.lit(False)
        rows = arrivals.join(ids, "url", "left").select(
            "url",
            F.when(is_new, first).alias("first"),
            F.struct(F.col("latest.title").alias("title"), F.col("latest.location").alias("location"), stamp.alias("last_seen_at")).alias("seen"),
            F.when(~F.coalesce(kept, F.lit(False)), F.struct(text.alias("value"))).alias("description"),
            F.struct(F.col("is_relevant").alias("value")).alias("is_relevant"),
            F.struct(F.col("latest.is_remote").alias("value")).alias("is_remote"),
            F.when(is_new, "first").otherwise("seen").alias("kind"),
        )
        self._append(rows, **entry, last_id=last_id + new)
        return stats

    def _of_known(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.known(), "url", "left_semi")

    def write_scores(self, scores: DataFrame) -> int:
        """Set the scores of (url, score), one row per URL; unknown URLs and null scores are ignored. Returns how many were set."""
        rows = stage(self._of_known(scores.where("score is not null").select("url", "score")), "scores")
        count = rows.count()
        if count:
            self._append(rows.withColumn("kind", F.lit("score")))
        return count

    def write_descriptions(self, texts: DataFrame) -> int:
        """Set the descriptions of (url, description), one row per URL; unknown URLs and empty texts are ignored."""
        rows = stage(self._of_known(texts.where("description <> ''").select("url", F.struct(F.col("description").alias("value")).alias("description"))), "texts")
        count = rows.count()
        if count:
            self._append(rows.withColumn("kind", F.lit("description")))
        return count

    def write_statuses(self, last: DataFrame) -> None:
        """Set statuses (url, status, changed_at), one row per URL; the newer one stays, and unknown URLs are ignored.

        A change without a time takes the time of the stored one.
        """
        rows = stage(self._of_known(last.where("status is not null").select("url", "status", "changed_at")), "statuses")
        if rows.isEmpty():
            return
        stored = self.changes("status").groupBy("url").agg(F.max("status.changed_at").alias("_at"))
        timed = rows.join(stored, "url", "left").withColumn("changed_at", F.coalesce("changed_at", "_at"))
        made = timed.select("url", F.struct(F.col("status").alias("value"), "changed_at").alias("status"), F.lit("status").alias("kind"))
        self._append(made)

    def rewrite(self, change: Callable[[DataFrame], DataFrame]) -> int:
        """Recompute columns of every posting with `change`, which keeps rows and other columns; returns how many differ now.

        Only rows that differ are appended. Title, location, description and the two flags may change.
        """
        changed = ("title", "location", "description", "is_relevant", "is_remote")
        before = F.struct(*changed)
        after = change(self.read().withColumn("_before", before)).where(~before.eqNullSafe(F.col("_before")))
        value = lambda c: F.struct(F.col(c).alias("value")).alias(c)
        rows = stage(
            after.select("url", F.struct("title", "location", "last_seen_at").alias("seen"), value("description"), value("is_relevant"), value("is_remote")),
            "rewritten",
        )
        count = rows.count()
        if count:
            self._append(rows.withColumn("kind", F.lit("flags")))
        return count

    def compacted(self, root: str) -> PostingStore:
        """The same table with one change for each posting, under a new root; this one stays as it is."""
        out, last = PostingStore(self.spark, root), self._last()
        value = lambda c: F.struct(F.col(c).alias("value")).alias(c)
        rows = newest(self._upto(last.number, ())).select(
            "url",
            F.struct("id", *ONCE, "first_seen_at").alias("first"),
            F.struct("title", "location", "last_seen_at").alias("seen"),
            *[value(c) for c in ("description", "is_relevant", "is_remote")],
            "score",
            F.struct(F.col("application_status").alias("value"), F.col("application_status_updated_at").alias("changed_at")).alias("status"),
            F.lit("first").alias("kind"),
        )
        # Scores keep a table of their own, which tells what is pending without reading postings.
        scores = rows.where("score is not null").select("url", "score", F.lit("score").alias("kind"))
        both = rows.drop("score").unionByName(scores, allowMissingColumns=True)
        both.hint("rebalance", "kind").write.mode("overwrite").partitionBy("kind").parquet(f"{out.root}/changes/number={max(last.number, 1)}")
        self.log().write.mode("overwrite").parquet(f"{out.root}/log")
        return out

    def record_run(
        self,
        source: str,
        started_at: datetime,
        finished_at: datetime,
        stats: Row | None = None,
        error: str | None = None,
    ) -> None:
        """Log a run that stored nothing, such as one that failed."""
        self._note(**(self._run_entry(source, started_at, stats, error) | {"finished_at": finished_at}))

    def record_rejects(self, rejects: DataFrame, source: str, at: datetime, batch_key: str | None = None) -> None:
        """Add (company_name, landed) rows of a run to the table of rejects; with a batch key, a replay replaces its own."""
        rows = rejects.select(
            F.lit(source).alias("source"), "company_name", F.col("landed").cast("string").alias("landed"), F.lit(at).alias("rejected_at")
        )
        if batch_key is None:
            rows.write.mode("append").parquet(f"{self.root}/rejects/batch=none")
        else:
            named = stage(rows, "rejects").withColumn("batch", F.sha2(F.lit(batch_key).cast("binary"), 256))
            named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.root}/rejects")


def _types() -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in T._parse_datatype_string(CHANGE).fields}
