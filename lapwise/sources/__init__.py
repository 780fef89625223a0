"""Files in, landed text out: entity layouts, line reader, partitioner, ledger, audit."""
