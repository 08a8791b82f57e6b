"""Incremental work.

The reference has no unbounded data: no timestamps, windows or watermarks.
Its only incremental behaviour is re-running chosen sections for chosen
regions and replacing their rows (S11).  ``incremental.refresh`` does that
with dynamic partition overwrite; ``incremental.refresh_on_arrival`` lets a
Structured Streaming file source of region lists trigger those refreshes
(one micro-batch = one refresh of the regions it names).
"""
