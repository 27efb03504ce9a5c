"""plans of lexaloom."""
