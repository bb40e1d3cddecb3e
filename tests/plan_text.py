"""The text of an executed plan, for tests that look into it."""


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
