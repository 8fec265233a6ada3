"""Row layouts shared by the jobs, as Spark schema strings."""

CORPUS = "row_id long, ddl string, question string, answer string"

CATALOG_TABLES = "schema_id long, table_ord int, table_key string, table_name string"

CATALOG_COLUMNS = (
    "schema_id long, table_key string, col_ord int, col_name string, dtype string, precision int, scale int, "
    "family string, is_pk boolean, is_fk boolean, fk_table string, fk_column string"
)

COLUMN_ROLES = "schema_id long, table_key string, role string, role_ord int, col_name string"

JOIN_EDGES = (
    "schema_id long, edge_ord int, from_table string, from_col string, to_table string, to_col string, kind string, "
    "to_known boolean"
)

JOIN_PATHS = (
    "schema_id long, from_table string, to_table string, hops int, "
    "steps array<struct<from_table:string,from_col:string,to_table:string,to_col:string>>"
)

QUESTION_FEATURES = (
    "row_id long, limit_n int, year int, years array<struct<op:string,year:int>>, status string, status_not boolean, agg string, wants_distinct boolean, wants_count boolean, "
    "wants_anti boolean, has_discount boolean, select_all boolean, order_desc boolean, order_col string, "
    "group_col string, tie_col string, tie_dir string, "
    "comparisons array<struct<col:string,op:string,value:decimal(18,4),number:string>>, value_words array<string>, "
    "tables_named array<string>, cols_named array<string>"
)

DRAFTS = "row_id long, shape string, sql string, problem string"

PREDICTIONS = "row_id long, label string, generated string, reference string, latency_ms double"

METRIC_LOG = "run_id string, ts timestamp, key string, value double, step long"

SERVING_LOG = "ts timestamp, model_version string, sql string, execution_time_ms double, tokens_generated int"

REPORT = (
    "label string, n_samples long, n_skipped long, exact_match_accuracy double, bleu4 double, avg_latency_ms double, "
    "p50_latency_ms double, p95_latency_ms double"
)
