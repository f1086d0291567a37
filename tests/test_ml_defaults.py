"""The registered training query fits the operator's own model, not a smaller one."""

from platewise import operator_queries as oq
from platewise.plans import ml

from conftest import SF_SMALL


def test_text_query_trains_with_the_defaults(spark, monkeypatch):
    models, real = [], ml.train_and_validate

    def kept(*a, **kw):
        models.append(real(*a, **kw)[0])
        return models[-1], None

    monkeypatch.setattr(oq.ml, "train_and_validate", kept)
    rows = oq.ml_train_text(spark, SF_SMALL).collect()
    default = ml.text_pipeline().getStages()
    got = models[0].stages
    assert got[2].getNumFeatures() == default[2].getNumFeatures() == 1 << 16
    assert got[-1].getMaxIter() == default[-1].getMaxIter() == 25
    assert sum(r.label == r.category_id for r in rows) >= 0.9 * len(rows) > 0
