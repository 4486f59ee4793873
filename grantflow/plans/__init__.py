"""Jobs: the steps of the pipeline put together, with their writes."""
