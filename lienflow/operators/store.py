"""The filing store: batches of Parquet files, each made valid by one commit row."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lienflow.functions.text import search_key
from lienflow.operators.audit import latest_runs
from lienflow.operators.sequences import HOT_ROWS
from lienflow.operators.upsert import OUTCOMES, merge
from lienflow.schema import FEED_FIELDS, FILING_FIELDS, FILING_SCHEMA, KEY, PARTY_SCHEMA, RUN_SCHEMA
from lienflow.sources.records import split_keyed

COUNTS = [f"n_{o}" for o in OUTCOMES]

# A batch is merged in up to so many parts, each of about so many rows and more.
PARTS = 16
PART_ROWS = 1_000_000

# What filings are counted by; sums of counts per batch give the statistics of the store at any time.
COUNTED_BY = ["state", "filing_status", "source_tier", "filing_date", "ingested_at"]
STATISTICS_SCHEMA = "state string, filing_status string, source_tier string, filing_date date, ingested_at timestamp, n long"

COMMIT_SCHEMA = "seq long, batch string, is_base boolean, replaced array<string>, tables array<string>, committed_at timestamp"
LEDGER_SCHEMA = "state string, delivery string, path string, size long, landed_at timestamp, is_read boolean"
EVENT_SCHEMA = (
    "event string, state string, run_id string, tier string, full_refresh boolean, records_fetched long, "
    "records_new long, records_updated long, records_skipped long, record_errors long, error string, timestamp timestamp"
)

_STORED = T.StructType(
    [
        *FILING_SCHEMA,
        T.StructField("search_key", T.StringType()),
        T.StructField("changed", T.BooleanType()),
        *[T.StructField(c, T.LongType()) for c in COUNTS],
        T.StructField("before", T.StructType([FILING_SCHEMA[f] for f in COUNTED_BY if f != "state"])),
        T.StructField("batch", T.StringType()),
    ]
)
_PARTIES = PARTY_SCHEMA + ", batch string"
PARTY_KEY = ["filing_state", "filing_number"]


@dataclass
class FilingStore:
    """Tables under one root; one writer at a time.

    A batch writes its rows under ``<table>/batch=<id>`` and rewrites nothing that is there; then one row in
    ``commits`` makes it valid.  Readers take committed batches only, so they see a batch whole or not at all,
    and one that broke off is simply written again.  A batch id that is committed is never applied twice.

    Filings are the rows of the base with those of later batches over them; ``compact`` folds all into a new base,
    by itself after ``compact_after`` batches where that is given.  Each batch also has the changes in the numbers of
    filings, so that counts and latest dates are read without a filing.  What a base has replaced stays readable as
    of an earlier commit until ``clean`` removes it.
    """

    spark: SparkSession
    root: str
    compact_after: int | None = None

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def batch_path(self, table: str, batch: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"a batch id has letters, digits, '_', '.' and '-' only: {batch}")
        return f"{self.path(table)}/batch={batch}"

    def read(self, table: str, schema: T.StructType | str) -> DataFrame:
        """All of a table, empty before its first write."""
        try:
            return self.spark.read.schema(schema).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    # -- commits ------------------------------------------------------------------------------------------

    def log(self) -> list:
        """All commits in order; each has a file of its own until ``clean`` folds them, and may then stand in two."""
        return sorted({r.seq: r for r in self.read("commits", COMMIT_SCHEMA).collect()}.values(), key=lambda r: r.seq)

    def commits(self, until: str | None = None) -> list:
        """The last base and what was committed after it, in order; ``until`` a batch for the store as it was then."""
        rows = self.log()
        if until is not None:
            last = next((r.seq for r in rows if r.batch == until), None)
            if last is None:
                raise ValueError(f"no such commit: {until}")
            rows = [r for r in rows if r.seq <= last]
        bases = [i for i, r in enumerate(rows) if r.is_base]
        return rows[bases[-1] :] if bases else rows

    def is_committed(self, batch: str) -> bool:
        return not self.read("commits", COMMIT_SCHEMA).filter(F.col("batch") == batch).isEmpty()

    def _commit(self, batch: str, tables: list[str], is_base: bool = False, replaced: list[str] | None = None) -> None:
        last = self.read("commits", COMMIT_SCHEMA).agg(F.max("seq")).first()[0] or 0
        row = self.spark.createDataFrame([(last + 1, batch, is_base, replaced or [], tables, None)], COMMIT_SCHEMA)
        row = row.withColumn("committed_at", F.current_timestamp())
        row.coalesce(1).write.mode("append").parquet(self.path("commits"))

    def _committed(self, table: str, schema: T.StructType | str, commits: list) -> DataFrame:
        """Rows of the committed batches that have the table, as their commits say: one scan."""
        paths = [self.batch_path(table, r.batch) for r in commits if table in r.tables]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)

    @staticmethod
    def _sequenced(rows: DataFrame, commits: list, state: str) -> DataFrame:
        """With the order of their commits, without what a later full delivery of the state replaced."""
        order = F.create_map(*[F.lit(x) for r in commits for x in (r.batch, r.seq)]) if commits else None
        rows = rows.withColumn("seq", order[F.col("batch")] if commits else F.lit(0).cast("long"))
        replaced = {s: r.seq for r in commits for s in r.replaced}
        for name, seq in replaced.items():
            rows = rows.filter(~((F.col(state) == name) & (F.col("seq") < seq)))
        return rows

    # -- filings ------------------------------------------------------------------------------------------

    def _current(self, until: str | None = None) -> DataFrame:
        commits = self.commits(until)
        rows = self._sequenced(self._committed("filings", _STORED, commits), commits, "state").filter("changed")
        if len(commits) < 2:
            return rows
        base, later = F.col("seq") == commits[0].seq, F.col("seq") > commits[0].seq
        latest = rows.filter(later)
        if sum("filings" in r.tables for r in commits[1:]) > 1:
            # A batch has a key once.  Only the columns that a reader asks for are shuffled.
            last = latest.groupBy(*KEY).agg(F.max("seq").alias("last_seq"))
            latest = latest.join(last, KEY).filter("seq = last_seq").drop("last_seq")
        kept = rows.filter(base).join(latest.select(*KEY), KEY, "left_anti")
        return kept.unionByName(latest)

    def filings(self, until: str | None = None) -> DataFrame:
        """One row per key, as the committed batches left it; ``until`` a batch, as that one left it."""
        return self._current(until).select(*FILING_FIELDS)

    def changes_between(self, first: str | None, last: str) -> DataFrame:
        """state, filing_number and change (added, changed, removed) from one commit to a later one.

        ``first`` None stands for the empty store.  Only keys that the commits between them name are compared, and
        all keys of states that one of them replaced; a change that was undone in between is none.
        """
        log = {r.batch: r.seq for r in self.log()}
        for batch in (first, last):
            if batch is not None and batch not in log:
                raise ValueError(f"no such commit: {batch}")
        start = log[first] if first else 0
        between = [r for r in self.log() if start < r.seq <= log[last] and not r.is_base]
        replaced = sorted({s for r in between for s in r.replaced})
        whole = F.col("state").isin(replaced) if replaced else F.lit(False)
        named = self._committed("filings", _STORED, between).filter("changed").filter(~whole).select(*KEY).distinct()
        kept = [*KEY, "source_raw", "last_updated_at"]

        def touched(rows: DataFrame) -> DataFrame:
            rows = rows.select(*kept)
            return rows.filter(~whole).join(named, KEY, "left_semi").unionByName(rows.filter(whole))

        old = touched(self.filings(first)) if first else self.spark.createDataFrame([], FILING_SCHEMA).select(*kept)
        old = old.select(*KEY, F.struct("source_raw").alias("old"))
        new = touched(self.filings(last)).select(*KEY, F.struct("source_raw").alias("new"))
        change = (
            F.when(F.col("old").isNull(), "added")
            .when(F.col("new").isNull(), "removed")
            .when(~F.col("old").eqNullSafe(F.col("new")), "changed")
        )
        return old.join(new, KEY, "full_outer").select(*KEY, change.alias("change")).filter("change IS NOT NULL")

    def statistics(self, until: str | None = None) -> DataFrame:
        """How many filings there are of each state, status, tier, filing date and time of ingestion.

        The sums of what each batch changed since the base: no filing is read.
        """
        rows = self._committed("statistics", STATISTICS_SCHEMA, self.commits(until))
        return rows.groupBy(*COUNTED_BY).agg(F.sum("n").alias("n")).filter("n <> 0")

    def searchable(self) -> DataFrame:
        """Filings with the stored ``search_key`` of the debtor."""
        return self._current().select(*FILING_FIELDS, "search_key")

    def upsert(
        self,
        records: DataFrame,
        as_of: str,
        batch: str,
        hot_rows: int = HOT_ROWS,
        replace: list[str] | None = None,
        parties: DataFrame | None = None,
        files: DataFrame | None = None,
        spent: list[str] | None = None,
    ) -> DataFrame:
        """Apply normalized records as one batch and return the outcome counts per state.

        The records are parsed once, into a table; of the stored filings only the keys in the batch are read,
        and of those the source text and what filings are counted by.  States in ``replace`` hold exactly the rows
        of the batch afterwards.  ``parties`` replace all parties of the filings they name.  ``files`` are those that
        the records came from: they are in the ledger as soon as the batch is valid, and not before.

        Only the batch's own tables stay on disk: the folders in ``spent``, which the records are read from, go as
        soon as they are staged, and what is staged goes with the commit.  A large batch is merged in parts of whole
        keys, one after the other, so that the shuffles of one part at a time are on disk.
        """
        if self.is_committed(batch):
            return self.outcomes(batch)
        replace = replace or []
        incoming = self.stage(records, batch)
        for path in spent or []:
            self.remove(path)
        keyed, rejects = split_keyed(incoming)
        fields = [F.col(f).cast(FILING_SCHEMA[f].dataType).alias(f) for f in FEED_FIELDS]
        rejected = rejects.select(*fields, "reject_reason", F.expr(as_of).alias("rejected_at"))
        rejected.write.mode("overwrite").parquet(self.batch_path("quarantine", batch))
        known = [*KEY, "source_raw", *COUNTED_BY]
        whole = F.col("state").isin(replace) if replace else F.lit(False)
        changed = ((F.col("n_new") + F.col("n_updated")) > 0) | whole
        for i, (part, inside) in enumerate(self._parts(keyed, batch)):
            held = self._near(self.filings().filter(inside), part).join(part.select(*KEY), KEY, "left_semi")
            stored = held.select(*[F.col(f) if f in known else F.lit(None).cast(FILING_SCHEMA[f].dataType).alias(f) for f in FILING_FIELDS])
            merged = merge(part, stored, as_of, hot_rows, always=whole, before=[c for c in COUNTED_BY if c != "state"])
            self._write(merged.withColumn("changed", changed), batch, more=i > 0)
        self._count(batch, replace)
        tables = ["filings", "statistics", "quarantine"]
        if parties is not None:
            named = parties.filter("filing_number IS NOT NULL AND filing_state IS NOT NULL").distinct()
            named.write.mode("overwrite").option("compression", "zstd").parquet(self.batch_path("filing_parties", batch))
            tables.append("filing_parties")
        if files is not None:
            files.write.mode("overwrite").parquet(self.batch_path("ledger", batch))
            tables.append("ledger")
        self._commit(batch, tables, replaced=replace)
        for table in ("incoming", "parts"):
            self.remove(self.batch_path(table, batch))
        if self.compact_after is not None and len(self.commits()) > self.compact_after:
            self.compact(f"base-of-{batch}")
        return self.outcomes(batch)

    def _parts(self, keyed: DataFrame, batch: str) -> list[tuple[DataFrame, Column]]:
        """The records of a batch in parts of whole keys, each with what tells its keys; a small batch is one part.

        The parts take the place of what was staged.
        """
        n = min(PARTS, keyed.count() // PART_ROWS + 1)
        if n == 1:
            return [(keyed, F.lit(True))]
        part = F.pmod(F.xxhash64(*KEY), F.lit(n)).cast("int")
        path = self.batch_path("parts", batch)
        keyed.withColumn("_part", part).write.mode("overwrite").partitionBy("_part").option("compression", "zstd").parquet(path)
        self.remove(self.batch_path("incoming", batch))
        schema = T.StructType([*keyed.schema.fields, T.StructField("_part", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(path)
        return [(rows.filter(F.col("_part") == i).drop("_part"), part == i) for i in range(n)]

    @staticmethod
    def _near(rows: DataFrame, keyed: DataFrame) -> DataFrame:
        """The stored rows that keys of a batch may be among: its states, and between its least and greatest numbers.

        Both bounds are literals by the time the scan is planned: folders of other states are not opened, and of the
        files, which are in order of the numbers, the parts beyond the bounds are not read.
        """
        spans = keyed.groupBy("state").agg(F.min("filing_number").alias("low"), F.max("filing_number").alias("high")).collect()
        if not spans:
            return rows.limit(0)
        within = [(F.col("state") == r.state) & F.col("filing_number").between(r.low, r.high) for r in spans]
        return rows.filter(F.col("state").isin([r.state for r in spans]) & reduce(lambda a, b: a | b, within))

    def _count(self, batch: str, replace: list[str]) -> None:
        """The change in the numbers of filings that a batch makes, from its own rows.

        A changed filing counts once as it is and once less as it was; of a state that is replaced all that was
        there goes.
        """
        rows = self.spark.read.schema(_STORED).option("basePath", self.path("filings"))
        rows = rows.parquet(self.batch_path("filings", batch)).filter("changed")
        whole = F.col("state").isin(replace) if replace else F.lit(False)
        now = rows.select(*COUNTED_BY, F.lit(1).alias("n"))
        was = rows.filter("before IS NOT NULL").filter(~whole).select("state", "before.*", F.lit(-1).alias("n"))
        gone = self.statistics().filter(whole).withColumn("n", -F.col("n"))
        changes = now.unionByName(was).unionByName(gone).groupBy(*COUNTED_BY).agg(F.sum("n").alias("n"))
        changes.filter("n <> 0").write.mode("overwrite").parquet(self.batch_path("statistics", batch))

    def write_rows(self, rows: DataFrame, table: str, batch: str) -> DataFrame:
        """The rows as a table of the batch, over what an earlier try left, read back from its files."""
        path = self.batch_path(table, batch)
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def stage(self, records: DataFrame, batch: str) -> DataFrame:
        """The records as a table of their own."""
        return self.write_rows(records, "incoming", batch)

    def outcomes(self, batch: str) -> DataFrame:
        """Outcome counts per state of a committed batch; its files never change."""
        rows = self.spark.read.schema(_STORED).option("basePath", self.path("filings"))
        held = rows.parquet(self.batch_path("filings", batch))
        return held.groupBy("state").agg(*[F.sum(c).alias(c) for c in COUNTS])

    def replace_state(self, state: str, records: DataFrame, as_of: str, batch: str) -> DataFrame:
        """A full delivery: the state holds exactly these records afterwards."""
        return self.upsert(records.filter(F.col("state") == state), as_of, batch, replace=[state])

    def compact(self, batch: str) -> None:
        """Fold the base and all later batches into a new base, filings and parties; readers notice nothing."""
        if self.is_committed(batch):
            return
        none = {c: F.lit(0).cast("long") for c in COUNTS} | {"before": F.lit(None).cast(_STORED["before"].dataType)}
        current = self._current().withColumns({"changed": F.lit(True)} | none)
        self._write(current.drop("search_key"), batch)
        self.parties().write.mode("overwrite").parquet(self.batch_path("filing_parties", batch))
        self.statistics().write.mode("overwrite").parquet(self.batch_path("statistics", batch))
        self.ledger().drop("batch").write.mode("overwrite").parquet(self.batch_path("ledger", batch))
        self._commit(batch, ["filings", "filing_parties", "statistics", "ledger"], is_base=True)

    def clean(self, older_than: str) -> list[str]:
        """Remove the filings, parties and counts of batches that a base replaced before a time; return the batches.

        ``older_than`` is a SQL expression such as ``current_timestamp() - interval 7 days``: a reader that began
        before the base still finds its files if it is done by then.  The log, the ledger, the run records and the
        quarantine stay.  The store cannot be read as of the removed commits any more.  Commit rows that are as old
        are folded into one file, so that a store of very many commits is opened with a short listing.
        """
        limit = self.spark.range(1).select(F.expr(f"timestamp({older_than})").alias("t")).first()["t"]
        rows = self.log()
        bases = [r.seq for r in rows if r.is_base and r.committed_at < limit]
        old = [r for r in rows if bases and r.seq < bases[-1]]
        removed = []
        for row in old:
            paths = [self.batch_path(t, row.batch) for t in ("filings", "filing_parties", "statistics") if t in row.tables]
            if any([self.remove(path) for path in [*paths, self.batch_path("incoming", row.batch)]]):
                removed.append(row.batch)
        self._fold_log(limit)
        return removed

    def _fold_log(self, limit) -> None:
        """Write the commit rows that are older than a time into one file, and remove what an older such file covers.

        A reader that has listed the files before finds them until the next call that comes late enough.
        """
        rows = self.spark.read.schema(COMMIT_SCHEMA).parquet(self.path("commits"))
        placed = rows.selectExpr("seq", "_metadata.file_path AS file", "_metadata.file_modification_time AS written")
        files = placed.groupBy("file", "written").agg(F.count("*").alias("n"), F.max("seq").alias("last")).collect()
        settled = [f for f in files if f.written < limit]
        whole = max((f for f in settled if f.n > 1), key=lambda f: f.last, default=None)
        covered = [f for f in settled if whole and f.file != whole.file and f.last <= whole.last]
        for file in covered:
            self.remove(file.file)
        left = [f.file for f in settled if f not in covered]
        if len(left) > 1:
            folded = self.spark.read.schema(COMMIT_SCHEMA).parquet(*left).dropDuplicates(["seq"])
            folded.coalesce(1).write.mode("append").parquet(self.path("commits"))

    def remove(self, path: str) -> bool:
        """Remove a folder or a file; whether it was there."""
        context = self.spark.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)

    def _write(self, rows: DataFrame, batch: str, more: bool = False) -> None:
        """By state, in files of even size, in order of the numbers, with bloom filters for lookups by number and key."""
        key = F.expr(search_key("debtor_name")).alias("search_key")
        placed = rows.select(*FILING_FIELDS, key, "changed", *[F.col(c).cast("long").alias(c) for c in COUNTS], "before")
        placed = placed.hint("rebalance", "state").sortWithinPartitions("state", "filing_number")
        writer = placed.write.mode("append" if more else "overwrite").partitionBy("state").option("compression", "zstd")
        for column in ("filing_number", "search_key"):
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(self.batch_path("filings", batch))

    # -- parties ------------------------------------------------------------------------------------------

    def parties(self) -> DataFrame:
        """The parties of every filing, as the last batch that names it has them."""
        commits = self.commits()
        rows = self._sequenced(self._committed("filing_parties", _PARTIES, commits), commits, "filing_state")
        last = rows.groupBy(*PARTY_KEY).agg(F.max("seq").alias("seq"))
        return rows.join(last, [*PARTY_KEY, "seq"], "left_semi").drop("seq", "batch")

    def upsert_parties(self, parties: DataFrame, batch: str) -> None:
        """Replace all parties of the filings in a batch, whatever their roles."""
        none = ", ".join(f"{f} {FILING_SCHEMA[f].dataType.simpleString()}" for f in FEED_FIELDS)
        records = self.spark.createDataFrame([], none + ", arrival struct<n:int>")
        self.upsert(records, "current_timestamp()", batch, parties=parties)

    # -- files --------------------------------------------------------------------------------------------

    def ledger(self) -> DataFrame:
        """The files that committed batches have read, or have passed over for a newer delivery."""
        return self._committed("ledger", f"{LEDGER_SCHEMA}, batch string", self.commits())

    # -- logs ---------------------------------------------------------------------------------------------

    def quarantine(self) -> DataFrame:
        """Rejects of all committed batches, with their batch; an earlier base hides none of them."""
        fields = ", ".join(f"{f} {FILING_SCHEMA[f].dataType.simpleString()}" for f in FEED_FIELDS)
        schema = f"{fields}, reject_reason string, rejected_at timestamp, batch string"
        return self._committed("quarantine", schema, self.log())

    def log_runs(self, runs: DataFrame, batch: str, phase: str) -> DataFrame:
        """Run records of a phase of a batch, over what an earlier try left, read back from their own files."""
        path = f"{self.batch_path('ingestion_runs', batch)}/phase={phase}"
        runs.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(RUN_SCHEMA).parquet(path)

    def log_events(self, events: DataFrame, batch: str, phase: str) -> None:
        """The event log, as JSON lines."""
        events.write.mode("overwrite").json(f"{self.batch_path('event_log', batch)}/phase={phase}")

    def runs(self) -> DataFrame:
        return self.read("ingestion_runs", RUN_SCHEMA).drop("batch", "phase")

    def events(self) -> DataFrame:
        try:
            found = self.spark.read.schema(EVENT_SCHEMA).json(self.path("event_log"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = self.spark.createDataFrame([], EVENT_SCHEMA)
        return found.drop("batch", "phase")

    def current_runs(self) -> DataFrame:
        return latest_runs(self.runs())


