"""Nested grids and the resumable result table."""

import json
from types import SimpleNamespace

import pytest

from covisit_spark.plans import sweep
from covisit_spark.plans.offline import Offline

SF = "/root/testdata/sf0.001"


def test_nested_grid_is_the_product_of_both_levels():
    grid = sweep.nested_grid({"neg_frac": [0.3, 0.5], "num_avg": [2]}, {"max_depth": [2, 3], "rounds": [4]})
    assert len(grid) == 4 and all(c["eval_at"] == 20 and c["num_avg"] == 2 for c in grid)
    assert {(c["neg_frac"], c["model"]["max_depth"]) for c in grid} == {(0.3, 2), (0.3, 3), (0.5, 2), (0.5, 3)}
    assert len({sweep.config_key(c) for c in grid}) == 4
    assert sweep.config_key(grid[0]) == sweep.config_key(json.loads(json.dumps(dict(reversed(grid[0].items())))))


def test_a_stopped_sweep_goes_on(spark, tmp_path):
    grid = sweep.nested_grid({"neg_frac": [0.1, 0.2, 0.3]}, {"rounds": [1]})
    ran, offline = [], SimpleNamespace(spark=spark)

    def evaluate(o, path, config, stop=None):
        if config["neg_frac"] == stop:
            raise KeyboardInterrupt
        ran.append(config["neg_frac"])
        return (json.dumps(config), *[config["neg_frac"]] * 6, 1, 1)

    with pytest.raises(KeyboardInterrupt):
        sweep.run_sweep(offline, grid, f"{tmp_path}/s", lambda *a: evaluate(*a, stop=0.2))
    assert ran == [0.1]
    rows = sweep.run_sweep(offline, grid + grid[:1], f"{tmp_path}/s", evaluate).collect()
    assert ran == [0.1, 0.2, 0.3]
    assert sorted(r["recall"] for r in rows) == [0.1, 0.2, 0.3] and len({r["config"] for r in rows}) == 3


def test_results_come_from_stored_models(spark, tmp_path):
    offline = Offline(spark, SF, num_cands=50)
    grid = sweep.nested_grid({"num_avg": [2]}, {"rounds": [2], "max_depth": [2], "min_rows": [5]})
    row = sweep.run_sweep(offline, grid, f"{tmp_path}/s").first()
    assert 0 < row["recall"] <= 1 and row["rounds_carts"] == 2 and 0 <= row["map_carts"] <= 1
    preds = sweep.rerank(offline, f"{tmp_path}/s", grid[0])
    again = sweep.rerank(Offline(spark.newSession(), SF, num_cands=50), f"{tmp_path}/s", grid[0])
    assert sorted(map(tuple, preds.collect())) == sorted(map(tuple, again.collect()))
