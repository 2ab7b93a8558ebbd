"""netsift: network-flow analytics as PySpark DataFrame functions.

Every public function takes DataFrames and returns DataFrames, so the same code
serves batch jobs and the micro-batches of a structured stream.
"""
