"""tidemark: a PySpark-native engine for candle time series."""

from tidemark import errors
from tidemark.functions.matrix import FeatureMatrix, assemble, features
from tidemark.operators.continuity import coverage, gap_report, missing_bars, repair_plan
from tidemark.operators.ingest import Downloader, DownloadResult, Orchestrator, PipelineConfig, PipelineRequest, PipelineResult, snapshot_tickers, sync_universe
from tidemark.operators.segments import segmented
from tidemark.operators.store import Store
from tidemark.operators.universe import universe_diff
from tidemark.operators.validation import validate, violations
from tidemark.sources import KlineDataSource, RestClient
from tidemark.spec import TechnicalFeaturesSpec
from tidemark.types import KlineInterval

__all__ = [
    "Downloader", "DownloadResult", "FeatureMatrix", "KlineDataSource", "KlineInterval", "Orchestrator", "PipelineConfig", "PipelineRequest", "PipelineResult",
    "RestClient", "Store", "TechnicalFeaturesSpec", "assemble", "coverage", "errors", "features", "gap_report", "missing_bars", "repair_plan", "segmented",
    "snapshot_tickers", "sync_universe", "universe_diff", "validate", "violations",
]
