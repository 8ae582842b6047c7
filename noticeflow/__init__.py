"""noticeflow: public-notice tracking as Spark DataFrame plans.

Captured listing pages go in; a versioned, deduplicated master table of notices
with submission deadlines and draft announcements comes out.  Every step is a
``DataFrame -> DataFrame`` function so Catalyst sees one plan end to end.
"""

__version__ = "0.1.0"
