"""Composed plans: the batch pipeline, the stream runs, and the registered query catalog."""

from hitscope.plans.batch import enriched_logs, pipeline_counts, previews, run_batch

__all__ = ["enriched_logs", "pipeline_counts", "previews", "run_batch"]
