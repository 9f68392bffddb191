"""The run written twice by ``scenario_sink`` is computed once."""

from faultline.plans import queries
from faultline.sources import sinks


def test_scenario_sink_searches_the_texts_once(spark, sf_dir, monkeypatch):
    read, write = [], sinks.write_run

    def noted(df, *args, **kwargs):
        read.extend(df.inputFiles())
        write(df, *args, **kwargs)

    monkeypatch.setattr(sinks, "write_run", noted)
    found = queries.queries()["scenario_sink"](spark, sf_dir).collect()
    assert found and "gone" not in {r.scenario for r in found}
    assert read and not [f for f in read if "events" in f]
