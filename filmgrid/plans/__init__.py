"""What a user calls: cleaning jobs, work lists, dashboard results, prediction, warehouse jobs."""
