"""trafficlens: web-analytics reporting (funnels, cohorts, uniques, cost,
incremental API loads) expressed as Spark DataFrame plans.

Layout:
  sources/    logical table schemas, the mart, test fixtures, report-API pages
  functions/  column expressions (calendar, tagging, column utilities)
  operators/  DataFrame -> DataFrame building blocks (filters, joins, aggregates, retention)
  plans/      the composite reports and the run-and-publish registry
  sinks/      append, temp views, report matrices, publishing
  streaming/  high-water mark, load windows, incremental append (batch and availableNow)
"""

from trafficlens.params import ReportParams
from trafficlens.session import build_session, checkpoint_root
from trafficlens.sources.mart import Mart
from trafficlens.plans.reports import REPORTS, REPORT_ORDER, ordered
from trafficlens.plans.registry import DESTINATIONS, publish, publish_all

__all__ = ["ReportParams", "build_session", "checkpoint_root", "Mart", "REPORTS", "REPORT_ORDER", "ordered",
           "DESTINATIONS", "publish", "publish_all"]
