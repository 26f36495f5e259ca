"""Co-training draws its lessons from every unlabelled row: the table's lessons against arrays and a plain sort."""

import numpy as np
from rankwell.llm import cotrain

WIDTH = 3
META = cotrain.SOURCES + cotrain.LANGS + 2


def pool_and_views(n, ties=1):
    rng = np.random.default_rng(5)
    rows = np.repeat(rng.normal(size=(n // ties, WIDTH + META)), ties, axis=0).astype(np.float32).astype(float)
    views = [cotrain.View(np.zeros(w), np.ones(w), np.append(rng.normal(size=w) * 2, 0.3)) for w in (WIDTH, META)]
    return rows, views


def table(spark, rows):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rows)], "h long, f array<float>")


def test_lessons_of_a_table_are_those_of_arrays(spark):
    rows, views = pool_and_views(600, ties=3)
    data = (rows[:, :WIDTH], rows[:, WIDTH:])
    for share in (0.01, 0.1, 0.9):
        local = cotrain.teach_in_memory(data)(views, share, 0.7)
        spread = cotrain.teach_from_table(table(spark, rows), WIDTH)(views, share, 0.7)
        for k in (0, 1):
            assert np.array_equal(local.by[k], spread.by[k]) and np.array_equal(local.data[k], spread.data[k])


def test_the_surest_rows_are_taken_with_their_ties():
    rows, views = pool_and_views(1000)
    data = (rows[:, :WIDTH], rows[:, WIDTH:])
    lesson = cotrain.teach_in_memory(data)(views, 0.2, 0.5)
    for k in (0, 1):
        margin = views[k].margin(data[k])
        steps = np.floor(margin / cotrain.STEP)
        sure = np.log(cotrain.SURE / (1 - cotrain.SURE))
        top, low = np.sort(margin)[::-1][99], np.sort(margin)[99]
        good = (steps >= np.floor(top / cotrain.STEP)) & (steps >= np.ceil(sure / cotrain.STEP))
        bad = (steps <= np.floor(low / cotrain.STEP)) & (steps < -np.ceil(sure / cotrain.STEP))
        assert (lesson.by[k] == 1).sum() == good.sum() and (lesson.by[k] == 0).sum() == bad.sum()


def test_odd_pools(spark):
    rows, views = pool_and_views(30)
    empty = cotrain.teach_from_table(table(spark, []), WIDTH)(views, 0.2, 0.5)
    assert empty.data[0].shape == (0, WIDTH) and empty.data[1].shape == (0, META) and not len(empty.by[0])
    few = cotrain.teach_from_table(table(spark, rows), WIDTH, most=4)(views, 1.0, 0.5)
    assert len(few.by[0]) == 4
    unsure = [cotrain.View(v.mean, v.scale, v.weights * 0) for v in views]
    assert not len(cotrain.teach_from_table(table(spark, rows), WIDTH)(unsure, 0.5, 0.5).by[0])
    alike = np.repeat(rows[:1], 30, axis=0)
    taught = cotrain.teach_from_table(table(spark, alike), WIDTH)(views, 0.1, 0.5)
    assert len(taught.by[0]) in (0, 30)
