from pyspark.sql import functions as F

from tidings.operators import model as md


def test_text_cv_counts_terms_once(spark, monkeypatch):
    held, real = {}, md.written
    rows = [(i, "good fine day" if i % 2 else "bad poor night" if i % 3 else "good poor noon", float(i % 2), 1.0, i // 2 % 2) for i in range(24)]
    data = spark.createDataFrame(rows, "id long, text string, label_idx double, weight double, fold int")

    def spy(df, name):
        out = real(df, name)
        held[name] = out.count()
        return out
    monkeypatch.setattr(md, "written", spy)
    got = md.text_cv(data, (0.1,))
    assert held == {"term-counts": len(rows)}
    want = []
    for k in range(2):
        m = md.text_pipeline(reg=0.1).fit(data.where(F.col("fold") != k))
        ok = m.transform(data.where(F.col("fold") == k)).agg(F.avg((F.col("prediction") == F.col("label_idx")).cast("int"))).first()[0]
        want.append((0.1, k, ok))
    assert got == want
