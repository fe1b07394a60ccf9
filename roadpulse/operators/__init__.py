"""DataFrame-to-DataFrame operators; batch and streaming input alike unless noted."""
