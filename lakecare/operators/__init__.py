"""DataFrame -> DataFrame operators that hold up when one key owns a third of the rows."""
