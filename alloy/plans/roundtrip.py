"""Queries that write through the sinks and read the result back.

Every write goes to a fresh folder under the shared checkpoint root.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from alloy.functions import sql
from alloy.operators import bronze as B
from alloy.operators import silver as S
from alloy.operators import state as ST
from alloy.operators import validate as V
from alloy.plans import oracle as O
from alloy.plans.catalog import (
    _ALL,
    _BRONZE_COLS,
    _ENTRY_COLS,
    _F0,
    _S12,
    _ALL0,
    _SILVER0,
    _SILVER1,
    _SNAKE_RAW,
    _entries_out,
    _source,
    register,
    scenario,
)
from alloy.plans.pipeline import cut, run_pipeline
from alloy.session import scratch_path
from alloy.sinks import buckets, store
from alloy.sources import fixture as FX
from alloy.sources import grid as G
from alloy.sources import sheets as SH
from alloy.streaming import marks as MK
from alloy.streaming.available_now import run_available_now

_SILVER_TWO_RUNS = O.with_ctes(*_ALL, select=O.upsert(_SILVER1, _S12))


@register("bronze_sink_roundtrip", O.with_ctes(*_ALL0, select=(
    f"SELECT {_BRONZE_COLS}, '20240201' AS date, '2024020100' AS run_key, 'run-all' AS load_id FROM bronze0")))
def bronze_sink_roundtrip(spark, sf_dir):
    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "bronze-roundtrip")
    store.write_bronze(sc.bronze0, root, sc.run0)
    b = store.read_bronze(spark, root)
    return b.select(*_BRONZE_COLS.split(", "), F.col("date").cast("string").alias("date"),
                    F.col("run_key").cast("string").alias("run_key"), "load_id")


@register("quarantine_roundtrip", O.with_ctes(*_F0, select=(
    "SELECT sheet_name, row_no, error_reason, '20240201' AS date, '2024020100' AS run_key FROM flag0 WHERE _error")))
def quarantine_roundtrip(spark, sf_dir):
    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "quarantine-roundtrip")
    store.write_quarantine(sc.errors0, root, sc.run0)
    q = spark.read.parquet(f"{root}/quarantine")
    return q.select("sheet_name", "row_no", "error_reason", F.col("date").cast("string").alias("date"),
                    F.col("run_key").cast("string").alias("run_key"))


@register("manifest_json_roundtrip", O.with_ctes(*O.base_ctes((0,)), select=f"SELECT {_ENTRY_COLS} FROM entries0"))
def manifest_json_roundtrip(spark, sf_dir):
    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "manifest-roundtrip")
    store.write_state(sc.current0, root, "manifest")
    return _entries_out(store.read_state(spark, root, "manifest", ST.MANIFEST_SCHEMA))


@register("manifest_unchanged", O.with_ctes(*O.base_ctes((0,)), select=(
    "SELECT false AS changed, count(*) AS n_open FROM entries0")))
def manifest_unchanged(spark, sf_dir):
    """Reconciling a run's entries against themselves changes nothing."""
    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "manifest-unchanged")
    store.write_state(sc.current0, root, "manifest")
    prev = store.read_state(spark, root, "manifest", ST.MANIFEST_SCHEMA)
    remaining, resolved = ST.reconcile(prev, sc.current0, sc.counts0)
    changed = ST.manifest_changed(prev, remaining, resolved)
    return remaining.agg(F.lit(changed).alias("changed"), F.count(F.lit(1)).alias("n_open"))


@register("silver_bootstrap", O.with_ctes(*_ALL0, select=_SILVER0))
def silver_bootstrap(spark, sf_dir):
    """Empty 33-column target + first merge, written as version 1 and read back."""
    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "silver-bootstrap")
    target = store.read_silver(spark, root, S.SILVER_SCHEMA)
    store.write_silver(S.upsert(target, sc.source0), root, spark)
    return store.read_silver(spark, root, S.SILVER_SCHEMA)


def _two_runs(spark, sf_dir, root, **kw):
    sc = scenario(spark, sf_dir)
    results = []
    for run, info in ((1, sc.run1), (2, sc.run2)):
        results.append(run_pipeline(spark, FX.landed_sheet(spark, sf_dir, run), root, info, sc.registry, **kw))
    return results


@register("pipeline_two_runs", _SILVER_TWO_RUNS)
def pipeline_two_runs(spark, sf_dir):
    """Both runs through the full pipeline (all sinks); the final silver table."""
    root = scratch_path(spark, "pipeline")
    _two_runs(spark, sf_dir, root, incremental_silver=False)
    return store.read_silver(spark, root, S.SILVER_SCHEMA)


@register("pipeline_silver_by_day", _SILVER_TWO_RUNS)
def pipeline_silver_by_day(spark, sf_dir):
    """Both runs with silver partitioned by business day: each merge rewrites
    only the days it touches; the final table equals the snapshot merge."""
    root = scratch_path(spark, "pipeline-by-day")
    _two_runs(spark, sf_dir, root, silver_layout="by_day", incremental_silver=False)
    return store.read_silver_by_day(spark, root, S.SILVER_SCHEMA)


@register("by_day_commit_interrupted", O.with_ctes(*_ALL, select=(
    f"SELECT 'interrupted' AS stage, * FROM ({_SILVER1}) UNION ALL BY NAME SELECT 'finished' AS stage, * FROM ({O.upsert(_SILVER1, _S12)})")))
def by_day_commit_interrupted(spark, sf_dir):
    """A merge that dies after it has written some of its days: readers see every old
    row and no new one; the merge is done again and is seen as a whole."""
    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "by-day-interrupted")
    store.upsert_silver_by_day(spark, root, sc.source1, S.SILVER_SCHEMA)
    merged, days = store.merge_days(spark, root, sc.source12, S.SILVER_SCHEMA)
    done = sorted(d for d in days if d is not None)[: len(days) // 2]
    store.stage_days(store.of_days(merged, done, "tanggal"), root)  # and here the job is lost
    before = cut(store.read_silver_by_day(spark, root, S.SILVER_SCHEMA), "checkpoint")
    store.upsert_silver_by_day(spark, root, sc.source12, S.SILVER_SCHEMA)
    after = store.read_silver_by_day(spark, root, S.SILVER_SCHEMA)
    return before.withColumn("stage", F.lit("interrupted")).unionByName(after.withColumn("stage", F.lit("finished")))


@register("silver_upsert_bucketed", _SILVER_TWO_RUNS)
def silver_upsert_bucketed(spark, sf_dir):
    """Silver bucketed by its match key: the first merge makes the buckets, the second
    joins them in place and writes the next version bucket by bucket."""
    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "bucketed")
    buckets.upsert_bucketed(spark, root, sc.source1, buckets=8)
    buckets.upsert_bucketed(spark, root, sc.source12)
    return buckets.read_bucketed(spark, root).select(*S.SILVER_COLS)


@register("pipeline_silver_bucketed", _SILVER_TWO_RUNS)
def pipeline_silver_bucketed(spark, sf_dir):
    """Both runs through the pipeline with bucketed silver."""
    root = scratch_path(spark, "pipeline-bucketed")
    _two_runs(spark, sf_dir, root, silver_layout="bucketed", incremental_silver=False)
    return buckets.read_bucketed(spark, root).select(*S.SILVER_COLS)


@register("table_from_frame", O.with_ctes(*_ALL0, select=(
    f"SELECT 'made' AS part, * FROM ({_SILVER0}) UNION ALL BY NAME SELECT 'filled twice' AS part, tanggal, toko, row_hash_raw FROM ({_SILVER0}) "
    f"UNION ALL BY NAME SELECT 'filled twice' AS part, tanggal, toko, row_hash_raw FROM ({_SILVER0})")))
def table_from_frame(spark, sf_dir):
    """Silver as a table of the catalog, created by DDL and partitioned by day, filled from
    a frame and read by name; and a typed table with fewer columns filled twice."""
    sc = scenario(spark, sf_dir)
    path = scratch_path(spark, "catalog-table")
    name = "alloy_" + path.rsplit("-", 1)[1]
    made = buckets.table_from_frame(sc.silver0, f"{name}_silver", ("tanggal",), f"{path}/silver")
    buckets.create_table(spark, f"{name}_keys", "toko string, row_hash_raw string, kreator string, tanggal date", ("tanggal",), f"{path}/keys")
    for mode in ("append", "replace", "append"):
        buckets.fill_table(made.select("tanggal", "row_hash_raw", "toko"), f"{name}_keys", mode)
    twice = spark.table(f"{name}_keys")
    return made.withColumn("part", F.lit("made")).unionByName(twice.withColumn("part", F.lit("filled twice")), allowMissingColumns=True)


def _incremental_sql() -> str:
    key = (f"{O.upper_trim('toko')} AS _a, {O.upper_trim('id_kreator')} AS _b, "
           "CAST(tanggal AS DATE) AS _c, pukul_live AS _d")
    touched = f"(SELECT DISTINCT {key} FROM bronze2)"
    src = (f"SELECT * FROM (SELECT * FROM bronze1 UNION ALL SELECT * FROM bronze2) b WHERE EXISTS ("
           f"SELECT 1 FROM {touched} t WHERE t._a IS NOT DISTINCT FROM {O.upper_trim('b.toko')} "
           f"AND t._b IS NOT DISTINCT FROM {O.upper_trim('b.id_kreator')} "
           "AND t._c IS NOT DISTINCT FROM CAST(b.tanggal AS DATE) AND t._d IS NOT DISTINCT FROM b.pukul_live)")
    return O.with_ctes(*_ALL, select=O.upsert(_SILVER1, O.silver_source(src)))


@register("pipeline_incremental_silver", _incremental_sql())
def pipeline_incremental_silver(spark, sf_dir):
    """Both runs, run 2 merging only the sessions its new bronze rows touch
    (older unkeyed rows are not inserted again, unlike the full merge)."""
    root = scratch_path(spark, "pipeline-incremental")
    _two_runs(spark, sf_dir, root, incremental_silver=True)
    return store.read_silver(spark, root, S.SILVER_SCHEMA)


_WM_AFTER_RUN1 = O.with_ctes(*_ALL, "rl AS (SELECT 'key_' || CAST(least(user_id % 5, 3) AS VARCHAR) AS creds, "
                             "arg_max('sheet_' || CAST(user_id % 5 AS VARCHAR), user_id % 5) AS name FROM events GROUP BY 1)",
                             select=("SELECT m.creds, rl.name AS sheet_name, m.last_processed_date, "
                                     "'2024-01-16T00:00:00' AS updated_at FROM maxd1 m LEFT JOIN rl ON m.creds = rl.creds"))


@register("empty_run", _WM_AFTER_RUN1)
def empty_run(spark, sf_dir):
    """Run 1's input again an hour later, marks compared by day: every row is at or
    before its source's watermark, so no bronze rows are written and the
    watermark is unchanged."""
    from alloy.operators.bronze import RunInfo

    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "empty-run")
    raw = FX.landed_sheet(spark, sf_dir, 1)
    run_pipeline(spark, raw, root, sc.run1, sc.registry)
    again = run_pipeline(spark, raw, root, RunInfo.at("2024-01-16 01:00:00", "run-1-again"), sc.registry,
                         watermark_by_day=True)
    if again.n_bronze or again.watermark_written:
        raise AssertionError("an unchanged input produced bronze rows")
    return store.read_state(spark, root, "watermark", ST.WATERMARK_SCHEMA)


_FROM_OLD = ["SELECT 'bronze' AS part, row_hash_raw AS what, path, sheet_name, row_no FROM bronze2",
             "SELECT 'marks', creds, NULL, max(last_processed_date), NULL FROM (SELECT * FROM maxd1 UNION ALL SELECT * FROM maxd2) GROUP BY creds",
             "SELECT 'open', coalesce(sheet_name, '') || error_date, NULL, creds, n_rows FROM remaining2"]


@register("pipeline_from_old_document", O.with_ctes(*_ALL, select=" UNION ALL ".join(_FROM_OLD)))
def pipeline_from_old_document(spark, sf_dir):
    """Run 2 starting from an earlier system's documents: watermarks in the old form
    (by sheet name, without creds) and the error manifest. Its bronze rows, and the marks
    and open entries that it writes, as documents again."""
    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "old-document")
    store.write_document(sc.wm_records1.drop("creds"), f"{root}/state/watermark.json", "sheets", ["sheet_name"])
    store.write_document(sc.s1.remaining, f"{root}/state/manifest.json", "errors", ST.KEYS)
    run_pipeline(spark, FX.landed_sheet(spark, sf_dir, 2), root, sc.run2, sc.registry, state_form="document")
    bronze = store.read_bronze(spark, root, S.BRONZE_SCHEMA)
    marks = store.read_state(spark, root, "watermark", ST.WATERMARK_SCHEMA)
    manifest = store.read_state(spark, root, "manifest", ST.MANIFEST_SCHEMA)
    none = F.lit(None)
    return (bronze.select(F.lit("bronze").alias("part"), F.col("row_hash_raw").alias("what"), "path", "sheet_name", "row_no")
            .unionByName(marks.select(F.lit("marks").alias("part"), F.col("creds").alias("what"), none.cast("int").alias("path"),
                                      F.col("last_processed_date").alias("sheet_name"), none.cast("bigint").alias("row_no")))
            .unionByName(manifest.select(F.lit("open").alias("part"), F.concat(F.coalesce("sheet_name", F.lit("")), "error_date").alias("what"),
                                         none.cast("int").alias("path"), F.col("creds").alias("sheet_name"), F.col("n_rows").alias("row_no"))))


@register("manifest_document_roundtrip", O.with_ctes(*O.base_ctes((0,)), select=f"SELECT {_ENTRY_COLS} FROM entries0"))
def manifest_document_roundtrip(spark, sf_dir):
    """The manifest as one document, a record a line, and read back."""
    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "manifest-document")
    store.write_state(sc.current0, root, "manifest", "document", ST.KEYS)
    return _entries_out(store.read_state(spark, root, "manifest", ST.MANIFEST_SCHEMA))


@register("watermark_sorted", O.with_ctes(*_ALL, select=(
    "SELECT creds, last_processed_date, row_number() OVER (ORDER BY creds) - 1 AS position FROM maxd1")))
def watermark_sorted(spark, sf_dir):
    """The watermark records as they stand in the document: sorted by source."""
    sc = scenario(spark, sf_dir)
    path = scratch_path(spark, "watermark-sorted")
    store.write_document(sc.wm_records1, path, "sheets", ["creds"])
    found = store.read_records(spark, path, "sheets", ST.WATERMARK_SCHEMA, True)
    return found.select("creds", "last_processed_date", F.col("_ord").cast("bigint").alias("position"))


@register("run_ids", O.with_ctes(*_ALL0, O.raw_cte(1), O.flag_cte(1), O.valid_cte(1), f"pre1 AS ({O.bronze_select('valid1', 1, 0)})", select=(
    "SELECT count(*) AS n_rows, 1 AS n_ids, true AS is_uuid FROM pre0 UNION ALL SELECT count(*), 1, true FROM pre1")))
def run_ids(spark, sf_dir):
    """Two runs with ids of their own: every row of a run has its id, and the ids differ."""
    sc = scenario(spark, sf_dir)
    runs = [B.build_bronze(V.valid_rows(V.flag(V.filter_creator_id(raw))), B.RunInfo.now())[0] for raw in (sc.raw0, sc.raw1)]
    rows = runs[0].select("run_id").unionByName(runs[1].select("run_id"))
    uuid = F.col("run_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(1).alias("n_ids"), F.bool_and(uuid).alias("is_uuid")).drop("run_id")


@register("stream_available_now", _SILVER_TWO_RUNS)
def stream_available_now(spark, sf_dir):
    """Both runs landed as files, one after the other, each consumed by an availableNow
    file stream with its default batches; the final silver table."""
    sc = scenario(spark, sf_dir)
    landing = scratch_path(spark, "landing")
    root = scratch_path(spark, "stream-tables")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    for run, info in ((1, sc.run1), (2, sc.run2)):
        FX.landed_grid(spark, sf_dir, run).write.mode("append").parquet(landing)
        run_available_now(spark, landing, root, sc.registry, checkpoint, run_for_landing=info, column_order=FX.FIXTURE_COLS,
                          incremental_silver=False)
    return store.read_silver(spark, root, S.SILVER_SCHEMA)


@register("stream_many_files", O.with_ctes(*_ALL0, select=_SILVER0))
def stream_many_files(spark, sf_dir):
    """A landing of many files, a few a micro-batch, with sheets whose header comes in
    another file: silver, merged once, is that of one batch over all rows."""
    sc = scenario(spark, sf_dir)
    landing = scratch_path(spark, "landing-many")
    FX.landed_grid(spark, sf_dir, 0).write.parquet(landing)
    root = scratch_path(spark, "stream-many")
    run_available_now(spark, landing, root, sc.registry, scratch_path(spark, "stream-many-checkpoint"), run_for_landing=sc.run0,
                      column_order=FX.FIXTURE_COLS, files_per_batch=6)
    return store.read_silver(spark, root, S.SILVER_SCHEMA)


@register("stream_keyed_marks", O.with_ctes(*_ALL, select=(
    "SELECT 'after 1' AS landing, creds, last_processed_date FROM maxd1 UNION ALL SELECT 'after 2', creds, max(last_processed_date) "
    "FROM (SELECT * FROM maxd1 UNION ALL SELECT * FROM maxd2) GROUP BY creds UNION ALL SELECT 'within 2', creds, last_processed_date FROM maxd1")))
def stream_keyed_marks(spark, sf_dir):
    """The marks as keyed state of a stream: after the first landing, and, with the stream
    restarted from its checkpoint, within the second and after it."""
    sc = scenario(spark, sf_dir)
    landing = scratch_path(spark, "landing-marks")
    checkpoint = scratch_path(spark, "marks-checkpoint")
    out = None
    for number, run, info in ((1, 1, sc.run1), (2, 2, sc.run2)):
        FX.landed_grid(spark, sf_dir, run).write.mode("append").parquet(landing)
        headers = G.headers_of(spark.read.schema(G.GRID_SCHEMA).parquet(landing))
        raw = G.grid_to_frame(spark.readStream.schema(G.GRID_SCHEMA).parquet(landing), headers, FX.FIXTURE_COLS)
        rows, _ = B.build_bronze(V.valid_rows(V.flag(V.filter_creator_id(raw))), info)
        MK.advance(rows.select("creds", "tanggal"), number, checkpoint)
        for name, at in ((f"within {number}", number), (f"after {number}", number + 1)):
            part = cut(MK.read_marks(spark, checkpoint, at).withColumn("landing", F.lit(name)), "checkpoint")
            out = part if out is None else out.unionByName(part)
    return out


@register("bronze_append_modes", O.with_ctes(*_ALL, select=(
    "SELECT 'append' AS mode, row_hash_raw, run_id FROM bronze1 UNION ALL "
    "SELECT 'append', row_hash_raw, run_id FROM bronze2 UNION ALL "
    "SELECT 'replace', row_hash_raw, run_id FROM bronze2 UNION ALL SELECT 'fail', row_hash_raw, run_id FROM bronze1")))
def bronze_append_modes(spark, sf_dir):
    """Both runs' bronze by each write mode; the first run is written twice when
    appending (a retry), and writing over a table that exists fails in mode fail."""
    from pyspark.errors import AnalysisException

    sc = scenario(spark, sf_dir)
    out = None
    for mode in store.MODES:
        root = scratch_path(spark, f"bronze-{mode}")
        store.write_bronze(sc.bronze1, root, sc.run1, mode)
        if mode == "append":
            store.write_bronze(sc.bronze1, root, sc.run1, mode)
        try:
            store.write_bronze(sc.bronze2, root, sc.run2, mode)
        except AnalysisException:
            if mode != "fail":
                raise
        part = store.read_bronze(spark, root, S.BRONZE_SCHEMA).select(F.lit(mode).alias("mode"), "row_hash_raw", "run_id")
        out = part if out is None else out.unionByName(part)
    return out


@register("two_runs_one_hour", O.with_ctes(*_ALL, select=(
    "SELECT row_hash_raw, path, sheet_name, row_no FROM bronze1 UNION ALL "
    "SELECT row_hash_raw, path, sheet_name, row_no FROM bronze2")))
def two_runs_one_hour(spark, sf_dir):
    """Both runs within one hour: bronze keeps the rows of both."""
    from alloy.operators.bronze import RunInfo

    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "one-hour")
    for run, minute in ((1, "10"), (2, "40")):
        run_pipeline(spark, FX.landed_sheet(spark, sf_dir, run), root, RunInfo.at(f"2024-02-01 06:{minute}:00", f"r{run}"), sc.registry)
    return store.read_bronze(spark, root, S.BRONZE_SCHEMA).select("row_hash_raw", "path", "sheet_name", "row_no")


@register("bronze_new_column", O.with_ctes(*_ALL, select=O.upsert(
    O.upsert(f"SELECT * FROM ({O.silver_source('SELECT * REPLACE (NULL AS nama_panggilan) FROM bronze1')}) WHERE false",
             O.silver_source("SELECT * REPLACE (NULL AS nama_panggilan) FROM bronze1")),
    O.silver_source("SELECT * REPLACE (NULL AS nama_panggilan) FROM bronze1 UNION ALL SELECT * FROM bronze2"))))
def bronze_new_column(spark, sf_dir):
    """A column that only the second run brings: silver has it."""
    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "new-column")
    store.write_bronze(sc.bronze1.drop("nama_panggilan"), root, sc.run1)
    first = cut(_source(store.read_bronze(spark, root, S.BRONZE_SCHEMA).drop(*store.BRONZE_PARTITIONS), True), "checkpoint")
    # Kept before the table grows: Spark takes two scans of one path for the same.
    silver = cut(S.upsert(S.empty_silver(spark), first), "checkpoint")
    store.write_bronze(sc.bronze2, root, sc.run2)
    both = cut(_source(store.read_bronze(spark, root, S.BRONZE_SCHEMA).drop(*store.BRONZE_PARTITIONS), True), "checkpoint")
    return S.upsert(silver, both)


@register("grid_headers_apart", O.with_ctes(O.raw_cte(0), select=f"SELECT {_SNAKE_RAW} FROM raw0"))
def grid_headers_apart(spark, sf_dir):
    """Headers landed before and apart from their rows: no cell is lost."""
    grid = FX.landed_grid(spark, sf_dir, 0)
    before = G.headers_of(grid.filter(F.col("row_no") <= 2))
    rows = grid.filter(F.col("row_no") > 2)
    return B.snake_rename(G.grid_to_frame(rows, G.known_headers(before, rows), FX.FIXTURE_COLS))


@register("sheet_source_scan", O.with_ctes(O.raw_cte(0), select=f"SELECT {_SNAKE_RAW} FROM raw0"))
def sheet_source_scan(spark, sf_dir):
    """The grid landed as a folder of JSON lines a worksheet, read by the sheet data source."""
    path = scratch_path(spark, "worksheets")
    FX.landed_grid(spark, sf_dir, 0).write.partitionBy("sheet_name", "creds").json(path)
    return B.snake_rename(SH.read_sheets(spark, path, FX.FIXTURE_COLS))


_SQL_HASH = [O.canon(O.q(c)) for c in ("Waktu Live", "Toko", "ID Kreator")]
_SQL_DAY = f"CAST({O.parse_date(O.q('Tanggal'))} AS DATE)"


@register("sql_surface", O.with_ctes(*_F0, select=(
    f"SELECT sheet_name, row_no, {_SQL_HASH[1]} AS toko, sha256(concat_ws('||', {', '.join(_SQL_HASH)})) AS hash, "
    f"{O.blank_cell(O.q('CTR'))} AS ctr_blank, {O.has_content(O.q('CTR'))} AS ctr_content, {O.percent_corrupt(O.q('CTR'))} AS ctr_corrupt, "
    f"{O.numeric_corrupt(O.q('GMV yang didapat dari LIVE (Rp)'))} AS gmv_corrupt, {O.number(O.q('GMV yang didapat dari LIVE (Rp)'))} AS gmv, "
    f"{O.percent_ratio(O.q('CTR'))} AS ctr, error_reason, {O.parse_date(O.q('Tanggal'))} AS parsed, "
    f"{O.session_hour(O.q('Waktu Live'))} AS hour, CASE WHEN d IS NOT NULL AND t IS NOT NULL THEN d + CAST(t AS TIME) END AS starts "
    f"FROM (SELECT *, {_SQL_DAY} AS d, {O.parse_hhmm(O.q('Waktu Live'))} AS t FROM flag0)")))
def sql_surface(spark, sf_dir):
    """The functions called in SQL text, over the flagged rows as a view."""
    sql.register(spark)
    scenario(spark, sf_dir).flagged_table0.createOrReplaceTempView("alloy_flagged")
    gmv = "`GMV yang didapat dari LIVE (Rp)`"
    return spark.sql(f"""
        SELECT sheet_name, row_no, alloy_canon(Toko) AS toko, alloy_raw_hash(array(`Waktu Live`, Toko, `ID Kreator`)) AS hash,
               alloy_is_blank(CTR) AS ctr_blank, alloy_has_content(CTR) AS ctr_content, alloy_percent_corrupt(CTR) AS ctr_corrupt,
               alloy_numeric_corrupt({gmv}) AS gmv_corrupt, alloy_number({gmv}) AS gmv, alloy_percent_ratio(CTR) AS ctr,
               alloy_error_reason(_corrupt, _date_error, _blank) AS error_reason, alloy_parse_date(Tanggal) AS parsed,
               alloy_session_hour(`Waktu Live`) AS hour,
               alloy_session_start(CAST(alloy_parse_date(Tanggal) AS DATE), alloy_parse_hhmm(`Waktu Live`)) AS starts
        FROM alloy_flagged""")


@register("fixes_roundtrip", O.with_ctes(*_ALL, select=(
    "SELECT sheet_name, creds, error_date, affected_columns, '2024-02-01T00:00:00' AS resolved_at, path, "
    "'fixed' AS status, '2024020100' AS run_key FROM resolved2")))
def fixes_roundtrip(spark, sf_dir):
    """The fix records as written and read back."""
    sc = scenario(spark, sf_dir)
    root = scratch_path(spark, "fixes")
    store.write_fixes(ST.fix_records(sc.s2.resolved, sc.run2.now_iso), root, sc.run2)
    return (store.read_fixes(spark, root, ST.FIX_SCHEMA).withColumn("affected_columns", F.array_join("affected_columns", ","))
            .drop("date", "load_id"))


_SPLIT = ("SELECT * REPLACE (CASE WHEN row_no % 2 = 0 THEN '9:30' ELSE '09:30' END AS waktu_live, NULL::INTEGER AS pukul_live) "
          "FROM bronze0")


@register("session_split_by_time", O.with_ctes(*_ALL0, select=(
    "SELECT tanggal, toko, id_kreator, waktu_live_time, count(*) AS n_rows FROM ("
    f"{O.silver_source(_SPLIT)}) GROUP BY ALL")))
def session_split_by_time(spark, sf_dir):
    """One time in two spellings, sessions kept apart by time, merged twice: every
    keyed session has one row."""
    sc = scenario(spark, sf_dir)
    times = F.when(F.col("row_no") % 2 == 0, F.lit("9:30")).otherwise(F.lit("09:30"))
    bronze = sc.bronze0.withColumn("waktu_live", times).withColumn("pukul_live", F.lit(None).cast("int"))
    source = cut(S.silver_source(bronze.drop("path"), split_by_time=True), "checkpoint")  # read six times
    S.require_unique(source)
    once = S.upsert(S.empty_silver(spark), source)
    twice = S.upsert(once, source).filter(F.col("tanggal").isNotNull() & F.col("toko").isNotNull() & F.col("id_kreator").isNotNull())
    loose = source.filter(F.col("tanggal").isNull() | F.col("toko").isNull() | F.col("id_kreator").isNull())
    return (twice.unionByName(loose).groupBy("tanggal", "toko", "id_kreator", "waktu_live_time")
            .agg(F.count(F.lit(1)).alias("n_rows")))


_HUGE = ("SELECT * REPLACE (CASE WHEN row_no % 3 = 0 THEN '999999999999999%' WHEN row_no % 3 = 1 THEN "
         "'0.00001' || CAST(row_no % 7 AS VARCHAR) || '%' ELSE ctr END AS ctr) FROM bronze0")


@register("clean_hash_extremes", O.with_ctes(*_ALL0, select=f"SELECT tanggal, toko, id_kreator, ctr_live, row_hash_clean FROM ({O.silver_source(_HUGE)})"))
def clean_hash_extremes(spark, sf_dir):
    """Huge and tiny ratios neither fail the merge nor vanish from the hash."""
    n = F.col("row_no")
    ctr = (F.when(n % 3 == 0, F.lit("999999999999999%"))
           .when(n % 3 == 1, F.concat(F.lit("0.00001"), (n % 7).cast("string"), F.lit("%"))).otherwise(F.col("ctr")))
    source = _source(scenario(spark, sf_dir).bronze0.withColumn("ctr", ctr))
    return source.select("tanggal", "toko", "id_kreator", "ctr_live", "row_hash_clean")
