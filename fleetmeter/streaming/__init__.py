"""The operators as streams: stored state tables fed per batch, and native stateful queries."""
