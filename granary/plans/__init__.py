"""Plan inspection."""
