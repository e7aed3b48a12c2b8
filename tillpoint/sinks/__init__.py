"""Sinks: keyed upserts of the sales tables, child replacement, queue
envelopes, dead letters and report output."""
