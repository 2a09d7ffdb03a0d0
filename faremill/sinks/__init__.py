from faremill.sinks.tables import (
    column_dictionary,
    comment_on_table,
    create_schema,
    read_table,
    write_table,
)

__all__ = ["column_dictionary", "comment_on_table", "create_schema", "read_table", "write_table"]
