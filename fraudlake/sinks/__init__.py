"""Writers that must stay whole when several of them, or a crash, meet one table."""
