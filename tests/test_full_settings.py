"""Registered experiment queries use the functions' defaults and the reference's model lists."""

import inspect

from conftest import SMALL

GBT50, BOOSTED = {"maxIter": 50, "maxDepth": 6}, ("gbt", {"maxIter": 100, "maxDepth": 10})


def test_registered_settings(spark, monkeypatch):
    import __spark_entry__ as E
    from flowaudit.operators import models as M
    from flowaudit.plans import experiments as XP
    queries, calls, fits = E.queries(), {}, []

    class Stop(Exception):
        pass

    class Fitted:
        fit_seconds = 0.0

    for name in ("cross_validate", "ablation", "imbalance_ablation", "split_strategy_experiment"):
        def fake(*a, _sig=inspect.signature(getattr(XP, name)), _name=name, **k):
            bound = _sig.bind(*a, **k)
            bound.apply_defaults()
            calls[_name] = bound.arguments
            return None, None
        monkeypatch.setattr(XP, name, fake)
    for q in ("ablation", "imbalance_ablation", "split_strategy_experiment"):
        queries[q](spark, SMALL)
    for q in ("ablation", "imbalance_ablation"):
        assert calls[q]["model_kind"] == "gbt_ovr" and not calls[q]["model_params"]
    assert list(calls["imbalance_ablation"]["strategies"]) == XP.IMBALANCE_STRATEGIES
    assert calls["split_strategy_experiment"]["models"] == M.DEFAULT_MODELS
    for q in ("cv_results", "cv_bootstrap_ci"):
        queries[q](spark, SMALL)
        assert calls["cross_validate"]["models"] == {
            "Random Forest": ("forest", {"numTrees": 50, "maxDepth": 30}),
            "Multilayer Perceptron": ("mlp", {"hidden": [64, 32], "maxIter": 20})}
        assert calls["cross_validate"]["k"] == 5

    def fit(train, features, label, kind, weight_col=None, seed=42, **params):
        fits.append((kind, params))
        return Fitted()
    monkeypatch.setattr(M, "fit", fit)
    monkeypatch.setattr(M, "evaluate_all", lambda models, *a, **k: models)
    assert list(queries["model_comparison"](spark, SMALL)) == list(M.DEFAULT_MODELS)
    assert fits == list(M.DEFAULT_MODELS.values())
    fits.clear()
    assert queries["train_all_times"](spark, SMALL).count() == len(M.DEFAULT_MODELS)
    assert fits == list(M.DEFAULT_MODELS.values()) and ("gbt_ovr", GBT50) in fits

    def stop(*a, **k):
        fit(*a, **k)
        raise Stop
    monkeypatch.setattr(M, "fit", stop)
    for q in ("permutation_importance", "global_attribution", "local_attribution", "global_importance_table"):
        fits.clear()
        try:
            queries[q](spark, SMALL)
        except Stop:
            pass
        assert fits == [BOOSTED], q
