"""The stream queries land each day range over all tasks, and stream only what they return."""

from pathlib import Path

import pytest

from barloom.plans import queries as Q
from barloom.streaming import stateful as SF
from barloom.streaming import trades as ST


class Drained:
    def awaitTermination(self):  # noqa: N802
        pass


def events(spark, path):
    spark.range(0, 3000, 1, 3).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, 850 * id) AS ts", "id % 7 AS user_id",
        "element_at(array('view', 'click'), cast(id % 2 + 1 AS int)) AS event_type", "cast(id AS double) AS value",
        "concat('{\"k\": ', id % 100, '}') AS props").write.parquet(f"{path}/events.parquet")
    return str(path)


@pytest.mark.parametrize("streamed", ["stream_trades", "stream_stateful_trades", "stream_stateful_bars"])
def test_landing_is_spread(spark, tmp_path, monkeypatch, streamed):
    landed, bars = [], []

    def drain(s, landing, *rest, **named):
        landed.append(len(list(Path(landing.removeprefix("file:")).glob("part-*"))))
        return Drained()

    def no_bars(*rest, **named):
        bars.append(1)
        return Drained()

    monkeypatch.setattr(ST, "trade_pipeline", drain)
    monkeypatch.setattr(SF, "start_trades", drain)
    monkeypatch.setattr(SF, "start_bars", no_bars)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):  # nothing is stored by the drains above
        Q.QUERIES[streamed](spark, events(spark, tmp_path))
    assert len(landed) == 3 and landed[0] > 1
    assert len(bars) == (6 if streamed == "stream_stateful_bars" else 0)
