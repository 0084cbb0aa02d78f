"""cityair: air-quality analytics expressed as Spark DataFrame / SQL plans.

Layout
------
functions/   column expressions and fixed domain constants
sources/     readers, payload flatteners, stand-ins built from the test tables, sinks
operators/   reusable relational recipes: upsert, grid range join, quality checks
plans/       the models: staging, marts, serving datasets, survey, documented extras
streaming/   incremental upsert driven by Structured Streaming
flow.py      end to end: landed files -> upserted raw tables -> models
__main__.py  command line (ingest, build, check, survey)
"""

from cityair.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
