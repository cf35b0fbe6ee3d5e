"""cartlake: cart-abandonment analytics over shop clickstreams, as Spark jobs."""
