"""DataFrame operators, one module per area; every operator is ``f(df, ...) -> DataFrame``."""
