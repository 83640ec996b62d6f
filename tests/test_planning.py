"""The state of ids over several days, and the requests that follow from it."""

from datetime import date

from tidemark import __main__ as cli
from tidemark.plans import planning
from tidemark.sources.store import Store


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def answers(spark, **has_data):
    return spark.createDataFrame([(int(k[1:]), v) for k, v in has_data.items()], "id long, has_data boolean")


def state(store):
    return {r.id: (r.listed, r.active, r.asked, r.change) for r in store.read("plan_x").collect()}


def asked(store):
    return [r.id_list for r in store.read("requests_x").orderBy("chunk_id").collect()]


def test_days(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    plan = planning.plan_day(store, "x", ids(spark, 1, 2, 3, 3, None), "id", date(2024, 1, 1), size=2)
    assert (plan.full, plan.added, plan.removed, plan.asked, plan.next_full_scan) == (True, 3, 0, 3, date(2024, 1, 31))
    assert asked(store) == ["1,2", "3"]
    # 3 gave no answer and 2 none with data; 4 is new, 1 is gone
    plan = planning.plan_day(store, "x", ids(spark, 2, 3, 4), "id", date(2024, 1, 2), answers(spark, i1=True, i2=False))
    assert (plan.full, plan.added, plan.removed, plan.active, plan.asked) == (False, 1, 1, 1, 1)
    assert state(store) == {
        1: (False, True, False, "removed"), 2: (True, False, False, None), 3: (True, False, False, None),
        4: (True, False, True, "added"),
    }
    # 1 comes back and was active; without answers activity stays
    for _ in range(2):  # planned twice, one plan
        plan = planning.plan_day(store, "x", ids(spark, 1, 2, 4), "id", date(2024, 1, 3))
        assert (plan.version, plan.added, plan.removed, asked(store)) == (3, 1, 1, ["1"])
    # the day of the next full scan: all that are listed
    plan = planning.plan_day(store, "x", ids(spark, 1, 2), "id", date(2024, 1, 31), answers(spark, i1=False))
    assert plan.full and plan.next_full_scan == date(2024, 3, 1) and asked(store) == ["1,2"]
    rows = {r.id: (str(r.first_seen), r.removed_at and str(r.removed_at)) for r in store.read("plan_x").collect()}
    assert rows == {1: ("2024-01-01", None), 2: ("2024-01-01", None), 3: ("2024-01-01", "2024-01-03"), 4: ("2024-01-02", "2024-01-31")}
    assert state(store)[1] == (True, False, True, None)


def test_nothing_listed(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    plan = planning.plan_day(store, "x", ids(spark), "id", date(2024, 1, 1))
    assert (plan.full, plan.asked, asked(store)) == (True, 0, [])
    assert planning.plan_day(store, "x", ids(spark, 5), "id", date(2024, 1, 2)).asked == 1


def test_one_join_a_day(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    planning.plan_day(store, "x", ids(spark, 1), "id", date(2024, 1, 1))
    df = planning.advance(store.read("plan_x"), ids(spark, 1, 2), None, "id", date(2024, 1, 2), False)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    ids(spark, 1, 2, 3).write.parquet(f"{tmp_path}/ids")
    answers(spark, i1=True).write.parquet(f"{tmp_path}/answers")
    cli.main(["plan", f"{tmp_path}/s", "x", f"{tmp_path}/ids", "--today", "2024-01-01"])
    cli.main(["plan", f"{tmp_path}/s", "x", f"{tmp_path}/ids", "--today", "2024-01-02", "--answers", f"{tmp_path}/answers"])
    assert "asked=3" in (out := capsys.readouterr().out) and "active=1, asked=1" in out
