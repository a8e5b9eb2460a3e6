"""Whole jobs, the derived inputs they are checked on, and the query registry."""
