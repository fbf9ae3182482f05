import __spark_entry__ as E


def test_every_operator_and_the_pipeline_are_registered():
    keys = set(E.queries()) - set(E.QUERIES)
    assert {int(k[2:].split("_")[0]) for k in keys if k != "pipeline"} == set(range(1, 14))
    assert len(keys) == 14 and "pipeline" in keys
