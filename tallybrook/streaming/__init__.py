"""The same work over streams and polled increments, with replay-safe output.

Everything a batch writes carries its batch number, and a batch that is replayed after a failure
replaces its own output. A checkpoint and an output folder therefore belong together.
"""
