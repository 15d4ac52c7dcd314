import inspect

from tabsieve.plans import registry


def test_search_query_has_the_operators_own_limits(monkeypatch):
    real, seen = inspect.signature(registry.trn.random_search), {}
    monkeypatch.setattr(registry, "_prepared_docs", lambda spark, d: ({"train": None, "dev": None}, []))
    monkeypatch.setattr(registry.trn, "random_search", lambda *a, **k: seen.update(real.bind(*a, **k).arguments))
    registry._l10(None, None)
    for name in ("n_trials", "timeout_s", "k"):
        assert seen.get(name, real.parameters[name].default) == real.parameters[name].default


def test_leaderboard_query_trains_whole_runs(monkeypatch):
    class Stop(Exception):
        pass

    seen = {}

    def baselines(*a, **k):
        seen.update(k)
        raise Stop

    monkeypatch.setattr(registry, "_prepared_docs", lambda spark, d: ({"train": None, "dev": None}, []))
    monkeypatch.setattr(registry.trn, "train_baselines", baselines)
    try:
        registry._l11(None, None)
    except Stop:
        pass
    assert seen.get("cv_folds", 10) == 10 and seen.get("importance", True)


def test_search_does_its_whole_work(spark, sf001):
    """Real fits: all trials of the registered search."""
    trials = registry.QUERIES["l10_random_search"](spark, sf001).collect()
    assert sorted(r["trial"] for r in trials) == list(range(50)) and all(0 <= r["score"] <= 1 for r in trials)
