"""estatelens: Spark jobs over Dutch insolvency-register data.

Every public function takes and returns Spark DataFrames or Columns.  Sub-packages:

``functions``  Column expressions (dates, classification, privacy, report figures)
``sources``    decoders for nested payloads, listing pages, the attempt log, tables
``operators``  joins, aggregates and worklists over whole tables
``plans``      multi-step jobs built from the above
``streaming``  Structured Streaming jobs
"""
