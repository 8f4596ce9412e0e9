"""tidewell: Spark jobs over large, time-stamped web-document corpora."""
