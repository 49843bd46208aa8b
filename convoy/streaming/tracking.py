"""What streams count besides their rows: rows that a source left out, by reason."""

from __future__ import annotations

from collections import Counter

from pyspark.sql.streaming import StreamingQueryListener

from convoy.sources.quality import METRICS


class DropCounts(StreamingQueryListener):
    """Adds up the counts that ``accounted`` observes in every micro-batch; add it with ``spark.streams.addListener``.

    ``counts[source][reason]`` are rows left out, ``counts[source]["rows_in"]`` all rows. A micro-batch counts once, also
    when it is run again after a restart.
    """

    def __init__(self) -> None:
        self.counts: dict[str, Counter] = {}
        self._seen: set[tuple] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            if not name.startswith(METRICS) or (progress.id, progress.batchId, name) in self._seen:
                continue
            self._seen.add((progress.id, progress.batchId, name))
            self.counts.setdefault(name.removeprefix(METRICS), Counter()).update({k: v for k, v in row.asDict().items() if v})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
