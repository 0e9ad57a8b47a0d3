"""Structured Streaming jobs for the three layers."""

from strata.streaming.jobs import (run_conform, run_raw, run_serving,  # noqa: F401
                                   stop_all, trigger_options)
