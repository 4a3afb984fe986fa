"""DuckDB check queries, written apart from the Spark jobs."""


def checks() -> dict[str, str]:
    from oracle import analysis, customers, operations, star

    return {**customers.CHECKS, **analysis.CHECKS, **star.CHECKS, **operations.CHECKS}
