"""The send cycle (F6): build the housing feed, publish it, then upsert the control table.

The reference has no streaming source; its incremental behaviour is this
feedback loop. Each run reads the *current* control snapshot, emits new and
changed people, and commits a new snapshot, so the next run only re-emits
people whose sources changed since they were last sent. A run that dies
before ``commit`` leaves the previous snapshot current; rerunning it is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedkit.context import RunContext, StagingScope
from feedkit.operators.control import ControlTable, control_source, upsert_control
from feedkit.plans.housing import housing_feed
from feedkit.sources.catalog import Sources, publish, published


def run_cycle(spark: SparkSession, src: Sources, control: ControlTable, ctx: RunContext,
              feed_path: str | None = None) -> tuple[DataFrame, int]:
    """One hourly run. Returns the feed as materialized and the current control version.

    The feed is written once (published, or staged) before the control upsert
    reads it back, so the upsert sees exactly the published lines. The control
    version is claimed before the feed is computed: of two runs that overlap, the
    later one fails before it publishes anything. In hours the gate leaves out
    nothing is committed. Tables staged on the way are freed when the run ends;
    only a feed without ``feed_path`` stays staged.
    """
    control.ensure()
    before = control.current_version()
    claim = control.claim(after=before)
    try:
        with StagingScope(spark) as scope:
            ctl = control.read(before)
            feed = housing_feed(src, ctl, ctx)
            if feed_path:
                publish(feed, feed_path)
                feed = published(spark, feed_path)
            else:
                feed = scope.keep(feed, "feed")
            if not ctx.gate_open():
                return feed, before
            new = upsert_control(ctl, control_source(feed, ctx.now_col(), ctx.tz), ctx.now_col())
            return feed, control.commit(new, claim=claim)
    finally:
        control.release(claim)
