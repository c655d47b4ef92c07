"""Fixed values that results depend on: extension classes of files."""

# Fixed values.
ZIP = (".zip", ".jar", ".war", ".ear")
ARCHIVE = (".7z", ".bz2", ".bzip2", ".gzip", ".lz", ".rar", ".tar", ".xz", ".zip")
AUDIO = (".aac", ".aiff", ".amr", ".flac", ".gsm", ".m4a", ".m4b", ".m4p", ".mp3", ".ogg", ".wma", ".aa", ".aax", ".ape", ".dsf", ".mpc", ".mpp", ".oga", ".wav", ".wv", ".webm")
BOOK = (".azw3", ".chm", ".djvu", ".epub", ".fb2", ".mobi", ".pdf")
DOC = (".accdb", ".doc", ".docm", ".docx", ".dot", ".dotm", ".dotx", ".mdb", ".ods", ".odt", ".pdf", ".potm", ".potx", ".ppt", ".pptm", ".pptx", ".rtf", ".xlm", ".xls", ".xlsm", ".xlsx", ".xlt", ".xltm", ".xltx", ".xps")
IMAGE = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".avif", ".arw", ".cr2", ".cr3", ".dng", ".nef", ".orf", ".raf", ".rw2", ".psd", ".psb", ".tiff", ".tif", ".svg", ".ai", ".eps", ".bmp", ".ico", ".heic", ".heif", ".pbm", ".pgm", ".ppm", ".pnm", ".apng", ".hdr", ".exr")
SOURCE = (".asm", ".bas", ".c", ".cc", ".ceylon", ".clj", ".coffee", ".cpp", ".cs", ".dart", ".elm", ".erl", ".go", ".groovy", ".h", ".hh", ".hpp", ".java", ".js", ".jsp", ".kt", ".kts", ".lua", ".nim", ".pas", ".php", ".pl", ".pm", ".py", ".rb", ".rs", ".scala", ".swift", ".tcl", ".vala", ".vb")
VIDEO = (".3gp", ".avi", ".flv", ".m4p", ".m4v", ".mkv", ".mov", ".mp4", ".mpeg", ".mpg", ".webm", ".wmv", ".ogv", ".asf", ".mpe", ".mpv", ".m2v")
