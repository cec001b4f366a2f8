import pyarrow as pa

from quillprep.llm import toxicity
from tests.llm.test_toxicity import table


def test_driver_gets_fitted_features_alone(spark, monkeypatch):
    docs, labels = table(spark)
    fitted, collected = [], []
    fit, collect = toxicity.fit_weights, type(docs).toArrow

    def counted(df):
        found = collect(df)
        collected.extend(len(c.combine_chunks().flatten()) for c in found.columns if pa.types.is_list(c.type))
        return found

    monkeypatch.setattr(toxicity, "fit_weights", lambda y, rows, *rest: fitted.append(len(rows)) or fit(y, rows, *rest))
    monkeypatch.setattr(type(docs), "toArrow", counted)
    model = toxicity.train(docs, labels)
    assert len(model.wanted) and collected == fitted
