from cases import con, docs, none, odd  # noqa: F401 - fixtures
