"""Sources and sinks: files, stored pages / payloads, generated work lists."""
