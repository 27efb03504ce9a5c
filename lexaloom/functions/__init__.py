"""functions of lexaloom."""
