"""Sources and sinks: readers (S1–S9, S11), records (S10/V8), sinks."""
