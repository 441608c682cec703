from .bucketed import BucketedTable
from .commits import commit_batch, commits, compact, read_committed, unlisted
from .ids import fits_broadcast, keep_unseen, require_ids
from .jdbc import append_jdbc, append_new_jdbc, create_table_jdbc, stored_ids, table_statements
from .merge import merge_first
from .kafka import kafka_write_options, publish
from .parquet import append_new, create_table, lookup, read_table, write_partitioned

__all__ = [
    "BucketedTable",
    "append_jdbc",
    "append_new",
    "append_new_jdbc",
    "commit_batch",
    "commits",
    "compact",
    "create_table",
    "create_table_jdbc",
    "fits_broadcast",
    "kafka_write_options",
    "keep_unseen",
    "lookup",
    "merge_first",
    "publish",
    "read_committed",
    "read_table",
    "require_ids",
    "stored_ids",
    "table_statements",
    "unlisted",
    "write_partitioned",
]
