from .progress import Backlog, BatchReport, files_behind
from .runner import (
    BatchSink,
    bucketed_sink,
    committed_sink,
    converting,
    earliest_sink,
    finish,
    jdbc_sink,
    parquet_sink,
    plain_logs,
    request_stop,
    run_chain,
    run_until_stopped,
    start_batches,
    start_console,
    start_files,
    start_kafka,
    stop_idle,
    withdraw_stop,
)

__all__ = [
    "Backlog",
    "BatchReport",
    "BatchSink",
    "bucketed_sink",
    "committed_sink",
    "converting",
    "earliest_sink",
    "files_behind",
    "finish",
    "jdbc_sink",
    "parquet_sink",
    "plain_logs",
    "request_stop",
    "run_chain",
    "run_until_stopped",
    "start_batches",
    "start_console",
    "start_files",
    "start_kafka",
    "stop_idle",
    "withdraw_stop",
]
