"""Query streams: several sessions' worth of the suite running at once.

The reference's "streams" are permutations of the 99 query templates run
concurrently (a throughput test), not data streams; no streaming source
or stateful operator exists in the workload.
"""
