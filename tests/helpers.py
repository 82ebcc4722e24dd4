"""Small frames in, plain rows out."""


def rows(df, *columns):
    """Rows as tuples, in a stable order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
