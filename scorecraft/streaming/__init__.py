"""No streaming operators: the reference has no watermark, event-time window
or stateful operator. The stateless transforms (``binning.apply_bins``,
``model.apply_scorecard``) work unchanged on streaming DataFrames."""
