"""operators of lexaloom."""
