"""sources of lexaloom."""
