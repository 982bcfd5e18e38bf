def same(df, con, sql):
    columns = sorted(df.columns)
    rel = con.sql(sql)
    assert sorted(rel.columns) == columns
    order = [rel.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == want
