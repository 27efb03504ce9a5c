"""streaming of lexaloom."""
