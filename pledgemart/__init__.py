"""Campaign analytics for pre-order and crowdfunding platforms, as Spark jobs."""
