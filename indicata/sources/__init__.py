"""Sources and sinks: delimited text, stage tables, history, submission folders."""
