"""What tests look for in the plan of a DataFrame."""


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
