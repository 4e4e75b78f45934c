"""parlance: speech-corpus preparation and transcript evaluation as Spark jobs.

Sub-packages:
  sources    readers and writers (manifests, JSON captions, dataset specs, sinks)
  functions  Column-level helpers (text normalisation, arrays, portable randomness,
             word alignment)
  operators  table operators (filters, slicing, gap merge, scoring, sampling,
             labels, vectors)
  plans      the three end-to-end flows plus the query catalog
  streaming  Structured Streaming forms of the stream-shaped operators
"""

__version__ = "0.1.0"
