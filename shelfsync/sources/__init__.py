"""Sources and sinks: tables, JDBC, folders of text files, file inventories, run logs, snapshots."""
