"""Alert message sink, lake writers and report writers."""
