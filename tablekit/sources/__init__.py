from tablekit.sources.files import (  # noqa: F401
    empty_like,
    query_path,
    read_csv,
    read_jdbc,
    read_json,
    read_parquet,
    table,
)
from tablekit.sources.generate import items, skewed_sales  # noqa: F401
from tablekit.sources.sinks import ctas, save_table, write_jdbc, write_parquet, write_sized  # noqa: F401
