"""Table types and domain constants."""

from __future__ import annotations

FACTS = "accession_number string, fact_name string, fact_value decimal(20,4), unit string, period_start date, period_end date, segment string, ord int"
FILINGS = "accession_number string, cik string, ticker string, filing_type string, filing_date date, period_of_report date, raw_html string, file_size_bytes int, ingested_at timestamp, pipeline_run_id string"
VERSIONS = "id bigint, cik string, filing_type string, period_of_report date, accession_number string, is_amendment boolean, superseded_by string, recorded_at timestamp"
STAGE_AUDIT = "id bigint, run_id string, stage string, status string, records_processed int, error_message string, created_at timestamp"
CHAIN_AUDIT = "id bigint, run_id string, system_id string, accession_number string, stage string, extraction_status string, detail string, content_hash string, prev_row_hash string, row_hash string, created_at timestamp"
MODEL_RUNS = "id bigint, run_id string, model_version string, model_sha256 string, git_sha string, filings_scored int, anomalies_flagged int, threshold double, drift_report string, drift_level string, created_at timestamp"
ANOMALIES = "id bigint, model_run_id bigint, accession_number string, score double, model_score double, rule_score double, is_anomaly boolean, triggered_by string, reason string, rule_violations array<struct<rule_id:string,severity:double,message:string>>, top_contributors array<struct<feature:string,z:double>>, scored_at timestamp"

# Concepts, features and limits of the domain.
PREFIX = "us-gaap:"
CONCEPTS = ("Revenues", "NetIncomeLoss", "OperatingIncomeLoss", "Assets", "Liabilities", "EarningsPerShareBasic", "CommonStockSharesOutstanding")
REVENUE_ALIAS = "RevenueFromContractWithCustomerExcludingAssessedTax"
REQUIRED = ("Revenues", "NetIncomeLoss", "Assets")
FEATURES = ("log_assets", "log_revenue", "net_margin", "operating_margin", "leverage", "roa", "asset_turnover", "eps_consistency", "revenue_yoy", "assets_yoy", "fact_coverage", "required_coverage", "period_years")
CLIP = 10.0
PSI_WARN, PSI_ALERT, PSI_EPSILON = 0.10, 0.25, 1e-4
DRIFT_MIN_SAMPLES, FLAG_RATE_TOLERANCE = 30, 3.0
SEED, CONTAMINATION, TREES, THRESHOLD, TOP_CONTRIBUTORS = 42, 0.05, 200, 0.6, 3
FLOORS = {"recall": 0.60, "precision": 0.35, "roc_auc": 0.85}
MAX_FLAG_RATE, REGRESSION_TOLERANCE = 0.30, 0.05
CHUNK_CHARS, CHUNK_OVERLAP, GROUNDING_FLOOR, SNIPPET, ANSWER_SNIPPET = 1200, 200, 0.15, 280, 400
CACHE_TTL_SECONDS = {"id": 3600, "filings": 86400, "facts": 604800}
