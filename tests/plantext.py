"""Physical plans as text, for checks on scans, shuffles and joins."""


def planned(df):
    """The plan before execution."""
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def executed(df):
    """The plan AQE ended up with."""
    df.collect()
    return planned(df)
